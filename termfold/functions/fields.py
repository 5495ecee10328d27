"""Splitting a cleaned body into its fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termfold import values as v
from termfold.functions.clean import strip


# The parts below are cut out without CASE branches: Spark evaluates a common
# subexpression, here the whole page, only once where no branch is in the way.


def last_part(text: Column, landmark: str) -> Column:
    """What follows the last landmark; the whole text if there is none."""
    return F.substring_index(text, landmark, -1)


def before_last(text: Column, landmark: str) -> Column:
    """What precedes the last landmark, '' if there is none: the length is negative then.

    Two linear scans. The regex ``(?s)(.*)landmark`` is quadratic on a long text
    without the landmark, as the matcher tries every start position.
    """
    kept = F.length(text) - F.length(last_part(text, landmark)) - len(landmark)
    return F.substring(text, F.lit(1), kept)


def after_last(text: Column, landmark: str) -> Column:
    """What follows the last landmark, '' if there is none: the length is zero then."""
    part = last_part(text, landmark)
    found = F.contains(text, F.lit(landmark)).cast("int")
    return F.substring(part, F.lit(1), F.length(part) * found)


def extract_categories(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(v.CATEGORY), F.lit(1))


def extract_external_links(text: Column) -> Column:
    """From the last links heading that a category follows, up to that category; '' if none."""
    with_heading = before_last(text, v.CATEGORY_OPEN)
    section = F.substring_index(after_last(with_heading, v.LINKS_HEADING), v.CATEGORY_OPEN, 1)
    return strip(section, v.REGEX_SPACE)


def extract_body(text: Column, keep_body_without_links: bool = False) -> Column:
    """The text before the last links heading.

    A page without the heading has an empty body unless ``keep_body_without_links``.
    """
    body = before_last(text, v.LINKS_HEADING)
    if keep_body_without_links:
        return F.when(F.contains(text, F.lit(v.LINKS_HEADING)), body).otherwise(text)
    return body


BRACES = r"\{+(?:infobox)?|\}+"
BOX = "struct<at: int, size: int>"


def infobox_positions(text: Column) -> Column:
    """Struct of box positions (0-based) and of where the rest begins, null for a page without an infobox.

    Each box runs from its opening to the braces that balance it. An unbalanced box ends the search and opens the rest.
    Runs of braces are taken in order with the running sum of the pairs in them: a run that opens adds its pairs, one
    that closes takes pairs away until the sum is zero. Outside a box only the last two braces before its name count.
    """
    runs = F.regexp_extract_all(text, F.lit(BRACES), F.lit(0))
    between = F.transform(F.split(text, BRACES, -1), F.length)
    steps = F.zip_with(
        runs,
        F.slice(between, 1, F.size(runs)),
        lambda run, gap: F.struct(
            gap.alias("gap"),
            F.length(run).alias("size"),
            F.when(F.endswith(run, F.lit("infobox")), F.length(run) - len("infobox")).otherwise(F.length(run)).alias("braces"),
            F.startswith(run, F.lit("{")).alias("opens"),
            F.endswith(run, F.lit("infobox")).alias("named"),
        ),
    )

    def step(so_far: Column, run: Column) -> Column:
        at, depth, pairs = so_far["at"] + run["gap"], so_far["depth"], F.shiftright(run["braces"], 1)
        inside, opens = depth > 0, run["opens"]
        closes = inside & ~opens & (pairs >= depth)
        starts = ~inside & opens & run["named"] & (pairs > 0)
        end = at + 2 * depth
        box = F.struct(so_far["opening"].alias("at"), (end - so_far["opening"]).alias("size"))
        return F.struct(
            (at + run["size"]).alias("at"),
            F.when(inside & opens, depth + pairs).when(inside & ~closes, depth - pairs).when(starts, 1).otherwise(0).alias("depth"),
            F.when(starts, at + run["braces"] - 2).otherwise(so_far["opening"]).alias("opening"),
            F.when(closes, end).otherwise(so_far["rest"]).alias("rest"),
            F.when(closes, F.concat(so_far["boxes"], F.array(box))).otherwise(so_far["boxes"]).alias("boxes"),
        )

    nothing = [F.lit(0).alias(name) for name in ("at", "depth", "opening", "rest")]
    found = F.aggregate(
        steps,
        F.struct(*nothing, F.array().cast(f"array<{BOX}>").alias("boxes")),
        step,
        lambda last: F.struct(
            last["boxes"].alias("boxes"),
            F.when(last["depth"] > 0, last["opening"]).otherwise(last["rest"]).alias("rest"),
        ),
    )
    return F.when(F.contains(text, F.lit(v.INFOBOX_OPEN)), found)


def infobox_content(text: Column, positions: Column) -> Column:
    """The insides of all boxes, one after the other without a separator."""
    opening, closing = len(v.INFOBOX_OPEN), len("}}")
    insides = F.transform(
        positions["boxes"],
        lambda box: F.substring(text, box["at"] + 1 + opening, box["size"] - opening - closing),
    )
    return F.coalesce(strip(F.array_join(insides, "")), F.lit(""))


def text_after_infobox(text: Column, positions: Column) -> Column:
    """What follows the last box; text in front of a box and between boxes is dropped."""
    rest = F.coalesce(positions["rest"], F.lit(0))
    return strip(F.substring(text, rest + 1, F.length(text)))
