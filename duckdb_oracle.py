"""The registered queries in SQL, for DuckDB, over the test tables.

Written apart from the Spark code: plain patterns instead of tuned ones, windows
instead of range slices, a regex form of the stemmer instead of Python.
"""

from __future__ import annotations

from termfold import values as v
from termfold.sources.tables import MARKUP_TEXT, MARKUP_TITLE

# These patterns, the ones in sequential(), single_pass(), BOXED and PARTED, and the stop lists decide the
# results and are stated plainly, as a yardstick.
JUNK = r"[~`!@#$%\-^*+{}\[\]|\\<>/?,:&]"
INFOBOX = r"\{\{infobox((?:[^{}]|\{\{[^{}]*\}\})*)\}\}"
# What strip() removes, as far as it is ASCII: 9 to 13 and 28 to 32.
SPACE = " || ".join(f"chr({n})" for n in [*range(9, 14), *range(28, 33)])
SPACE = f"({SPACE})"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(by)}, 'g')"


def words_list(words: list[str]) -> str:
    return "(" + ", ".join(map(quoted, words)) + ")"


def sequential(text: str) -> str:
    for pattern, by in [
        (r"\{\{(cite|vcite)\s+[^\}]*\}\}", ""),
        (r"[.,;_()/\"'=]", " "),
        (r"\[\[file:[^\]]*\]\]", ""),
        (r"<[^>]*>", ""),
        (r"[^\x00-\x7F]+", ""),
    ]:
        text = replace(text, pattern, by)
    return text


def single_pass(text: str) -> str:
    pattern = r"\{\{(cite|vcite)\s+[^\}]*\}\}|[.,;_()/\"'=]|\[\[file:[^\]]*\]\]|<[^>]*>|[^\x00-\x7F]+"
    return replace(text, pattern, " ")


def initial_capitals(text: str) -> str:
    return f"""array_to_string(list_transform(string_split({text}, ' '),
      lambda x: CASE WHEN left(x, 1) = 'ß' THEN 'Ss' ELSE upper(left(x, 1)) END || lower(substr(x, 2))), ' ')"""


def junk(text: str) -> str:
    return replace(replace(text, JUNK, " "), r"\n", " ")


def squeeze(text: str) -> str:
    return f"trim({replace(text, r'\s+', ' ')})"


# --- common table expressions ------------------------------------------------

WIKI = f"wiki AS (SELECT cast(doc_id AS varchar) AS Id, {MARKUP_TITLE} AS Title, {MARKUP_TEXT} AS Text FROM documents)"
CASED = "cased AS (SELECT Id, lower(Title) AS Title, lower(Text) AS Text FROM wiki)"


def cleaned(cleaning=sequential) -> str:
    return f"cleaned AS (SELECT Id, Title, {cleaning('Text')} AS Text FROM cased)"


BOXED = rf"""boxed AS (
  SELECT Id, Title,
         regexp_extract_all(Text, '\[\[category:(.*?)\]\]', 1) AS Categories,
         coalesce(trim(array_to_string(regexp_extract_all(Text, '(?s){INFOBOX}', 1), ''), {SPACE}), '') AS Infobox,
         CASE WHEN regexp_matches(Text, '(?s){INFOBOX}')
              THEN trim(regexp_extract(Text, '(?s)^.*{INFOBOX}(.*)$', 2), {SPACE})
              ELSE trim(Text, {SPACE}) END AS Remaining_Text
  FROM cleaned)"""

# What the parts of the nested pages are known to give, without looking for braces.
NESTED = f"""
SELECT cast(doc_id AS varchar) AS Id,
  trim(lower(CASE doc_id % 5
    WHEN 1 THEN concat('a ', source, ' {{{{b|{{{{c|{{{{d ', lang, '}}}} }}}} }}}} e')
    WHEN 2 THEN concat('first ', source, ' second {{{{x}}}} ', lang)
    WHEN 3 THEN concat('whole ', lang)
    WHEN 4 THEN concat('odd {{{{{{', source, '}}}}}} {{z}} ')
    ELSE '' END), {SPACE}) AS Infobox,
  trim(lower(CASE doc_id % 5
    WHEN 0 THEN concat('Lead ', lang, ' ', text)
    WHEN 3 THEN concat('{{{{infobox open {{{{y}}}} ', text)
    WHEN 4 THEN concat('}} ', text)
    ELSE text END), {SPACE}) AS Remaining_Text
FROM documents"""

PARTED = r"""parted AS (
  SELECT Id, Title, Categories, Infobox, Remaining_Text,
         regexp_extract(Remaining_Text, '(?s).*external links\s*([\s\S]*?)\s*\[\[category', 1) AS External_Links,
         regexp_extract(Remaining_Text, '(?s)(.*)external links', 1) AS Text
  FROM boxed)"""

CATEGORY_NAMES = (
    f"array_to_string(list_transform(Categories, lambda x: trim({replace('x', JUNK, '')})), ' ')"
)

FIELDED = f"""fielded AS (
  SELECT Id,
         {squeeze(replace('Title', JUNK, ' '))} AS Title,
         {squeeze(junk('Text'))} AS Text,
         coalesce({CATEGORY_NAMES}, '') AS Categories,
         {squeeze(replace(replace('Infobox', chr(10), ' '), '[^a-zA-Z0-9_]', ' '))} AS Infobox,
         {squeeze(junk('External_Links'))} AS External_Links
  FROM parted)"""

FIELD_WORDS = "field_words AS (" + " UNION ALL ".join(
    f"SELECT Id, '{field}' AS field, unnest(string_split({field}, ' ')) AS Word FROM fielded"
    for field in v.FIELDS
) + ")"
KEPT = f"kept AS (SELECT * FROM field_words WHERE Word <> '' AND Word NOT IN {words_list(v.INDEX_STOP_WORDS)})"


def counts(source: str, name: str = "counts", word: str = "Word") -> str:
    columns = ", ".join(f"count(*) FILTER (field = '{field}') AS {field}" for field in v.FIELDS)
    return f"{name} AS (SELECT Id, {word} AS Word, {columns} FROM {source} GROUP BY Id, {word})"


DOCUMENTS = [WIKI, CASED, cleaned(), BOXED, PARTED, FIELDED]
PLAIN = [*DOCUMENTS, FIELD_WORDS, KEPT, counts("kept")]


# --- the stemmer as regular expressions --------------------------------------

def shape(word: str) -> str:
    """Consonant y's in upper case."""
    word = f"regexp_replace({word}, '^y', 'Y')"
    word = rf"regexp_replace({word}, '([aeiou])y', '\1Y', 'g')"
    return f"regexp_replace({word}, 'yy', 'yY', 'g')"


def more_than_0(word: str) -> str:
    return f"regexp_matches({shape(word)}, '^[^aeiouy]*[aeiouy]+[^aeiouy]')"


def more_than_1(word: str) -> str:
    return f"regexp_matches({shape(word)}, '^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]')"


def has_vowel(word: str) -> str:
    return f"regexp_matches({shape(word)}, '[aeiouy]')"


def ends_consonant(word: str) -> str:
    return f"regexp_matches({shape(word)}, '[^aeiouy]$')"


def short(word: str) -> str:
    return f"regexp_matches({shape(word)}, '[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$')"


def suffixes(table: str, condition=more_than_0, more: str = "") -> str:
    cases = []
    for rule in table.split("  "):
        suffix, _, ending = rule.strip().partition(" ")
        stem = f"left(w, -{len(suffix)})"
        test = condition(stem)
        if suffix == "ion":
            test = f"{test} AND right({stem}, 1) IN ('s', 't')"
        cases.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {test} THEN {stem} || '{ending}' ELSE w END"
        )
    return f"CASE {more} {' '.join(cases)} ELSE w END"


STEP_2 = (
    "ational ate  tional tion  enci ence  anci ance  izer ize  bli ble  alli al  entli ent  eli e  "
    "ousli ous  ization ize  ation ate  ator ate  alism al  iveness ive  fulness ful  ousness ous  "
    "aliti al  iviti ive  biliti ble  fulli ful"
)
STEP_3 = "icate ic  ative  alize al  iciti ic  ical ic  ful  ness"
STEP_4 = "al  ance  ence  er  ic  able  ible  ant  ement  ment  ent  ion  ou  ism  ate  iti  ous  ive  ize"
LOGI = f"WHEN ends_with(w, 'logi') THEN CASE WHEN {more_than_0('left(w, -3)')} THEN left(w, -1) ELSE w END"
OWN_STEMS = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


def stems(source: str, name: str = "stems") -> list[str]:
    """CTEs that end in ``name(Word, Stem)`` for the distinct words of ``source``."""
    steps = [
        f"""CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN left(w, -1)
             WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, -2)
             WHEN ends_with(w, 'ss') THEN w
             WHEN ends_with(w, 's') THEN left(w, -1) ELSE w END AS w""",
        f"""w, CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
             WHEN ends_with(w, 'ed') AND {has_vowel('left(w, -2)')} THEN left(w, -2)
             WHEN ends_with(w, 'ing') AND {has_vowel('left(w, -3)')} THEN left(w, -3) END AS cut""",
        f"""CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN left(w, -1) ELSE left(w, -2) END
             WHEN ends_with(w, 'eed') THEN CASE WHEN {more_than_0('left(w, -3)')} THEN left(w, -1) ELSE w END
             WHEN cut IS NULL THEN w
             WHEN ends_with(cut, 'at') OR ends_with(cut, 'bl') OR ends_with(cut, 'iz') THEN cut || 'e'
             WHEN length(cut) > 1 AND right(cut, 1) = left(right(cut, 2), 1) AND {ends_consonant('cut')}
               THEN CASE WHEN right(cut, 1) IN ('l', 's', 'z') THEN cut ELSE left(cut, -1) END
             WHEN {more_than_0('cut')} AND NOT {more_than_1('cut')} AND {short('cut')} THEN cut || 'e'
             ELSE cut END AS w""",
        f"""CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND {ends_consonant('left(w, -1)')}
             THEN left(w, -1) || 'i' ELSE w END AS w""",
        f"""CASE WHEN ends_with(w, 'alli') AND {more_than_0('left(w, -4)')} THEN left(w, -2) ELSE w END AS w""",
        f"{suffixes(STEP_2, more=LOGI)} AS w",
        f"{suffixes(STEP_3)} AS w",
        f"{suffixes(STEP_4, more_than_1)} AS w",
        f"""CASE WHEN ends_with(w, 'e') AND ({more_than_1('left(w, -1)')}
             OR ({more_than_0('left(w, -1)')} AND NOT {short('left(w, -1)')})) THEN left(w, -1) ELSE w END AS w""",
        f"CASE WHEN ends_with(w, 'll') AND {more_than_1('left(w, -1)')} THEN left(w, -1) ELSE w END AS w",
    ]
    own = " ".join(f"WHEN Word = '{word}' THEN '{stem}'" for word, stem in OWN_STEMS.items())
    ctes = [f"{name}_0 AS (SELECT DISTINCT Word, Word AS w FROM {source})"]
    for i, step in enumerate(steps):
        ctes.append(f"{name}_{i + 1} AS (SELECT Word, {step} FROM {name}_{i})")
    return [
        *ctes,
        f"{name} AS (SELECT Word, CASE {own} WHEN length(Word) <= 2 THEN Word ELSE w END AS Stem FROM {name}_{len(steps)})",
    ]


STEMMED_WORDS = "stemmed_words AS (SELECT Id, field, Stem FROM kept JOIN stems USING (Word))"
STEMMED = [
    *DOCUMENTS, FIELD_WORDS, KEPT, *stems("kept"), STEMMED_WORDS, counts("stemmed_words", word="Stem"),
]

# --- index and search --------------------------------------------------------

POSTING = "Id || ':' || Title || '-' || Text || '-' || Categories || '-' || Infobox || '-' || External_Links"


def segmented(segment_size: int) -> str:
    slot = "('0x' || substr(md5(Id), 1, 8))::BIGINT"
    documents = "count(*) OVER (PARTITION BY Word)"
    parts = f"cast(ceil({documents} / {segment_size}) AS BIGINT)"
    return f"""segmented AS (
      SELECT *, cast(CASE WHEN {documents} > {segment_size} THEN {slot} % {parts} ELSE 0 END AS INTEGER) AS segment
      FROM counts)"""


def postings(segment_size: int = 100_000) -> list[str]:
    return [
        segmented(segment_size),
        f"""postings AS (SELECT Word, segment, count(*) AS documents, string_agg(Id, ',' ORDER BY Id) AS doc_ids,
              string_agg({POSTING}, '#' ORDER BY Id) AS Document_Counts FROM segmented GROUP BY Word, segment)""",
    ]


VOCABULARY = "vocabulary AS (SELECT Word, row_number() OVER (ORDER BY Word) AS rank FROM (SELECT DISTINCT Word FROM counts))"
BATCHES = f"batches AS (SELECT Word, cast((rank - 1) // {v.BATCH_SIZE} AS INTEGER) AS batch FROM vocabulary)"
SECONDARY = "secondary AS (SELECT batch, min(Word) AS first_word FROM batches GROUP BY batch)"

QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
QUERY_WORDS = f"""query_words AS (
  SELECT query_id, Word FROM (
    SELECT query_id, unnest(regexp_extract_all(lower(query), '[a-zA-Z0-9]+')) AS Word FROM queries)
  WHERE Word NOT IN {words_list(v.QUERY_STOP_WORDS)})"""
TERMS = "terms AS (SELECT query_id, Word, count(*) AS repeats FROM query_words GROUP BY query_id, Word)"
QUERY_TERMS = [QUERIES, QUERY_WORDS, TERMS]


STEMMED_QUERY_TERMS = [
    QUERIES, QUERY_WORDS, *stems("query_words", "query_stems"),
    """terms AS (SELECT query_id, Stem AS Word, count(*) AS repeats
         FROM query_words JOIN query_stems USING (Word) GROUP BY query_id, Stem)""",
]

SCORE = "500 * Title + Text + 50 * Categories + 50 * Infobox + 50 * External_Links + 50"
SCORES = f"""scores AS (SELECT query_id, Id AS key, cast(sum(repeats * ({SCORE})) AS BIGINT) AS score
  FROM terms JOIN counts USING (Word) GROUP BY query_id, Id)"""
RANKED = """ranked AS (SELECT query_id, key, score,
  row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS rank FROM scores)"""

# --- one statement per registered query ---------------------------------------

def statement(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def joined(separator: str) -> str:
    def words(field: str) -> str:
        kept = f"list_filter(string_split({field}, ' '), lambda x: {{}})"
        return f"coalesce(array_to_string({kept}, '{separator}'), '') AS {field}"

    return ", ".join(words(field) for field in v.FIELDS)


FIELD_COLUMNS = ", ".join(v.FIELDS)
NOT_EMPTY = joined("|").replace("{}", "x <> ''")
NOT_STOPPED = joined("|").replace("{}", f"x <> '' AND x NOT IN {words_list(v.INDEX_STOP_WORDS)}")
INDEX_ROWS = "SELECT batch, Word, segment, Document_Counts FROM postings JOIN batches USING (Word)"
HITS = "SELECT query_id, Word, repeats, segment, Document_Counts FROM terms JOIN postings USING (Word)"
SUCCESS = "to_json({'string': query, 'status': 'success', 'results': list({'key': key, 'score': score} ORDER BY rank)})"
ERROR = f"to_json({{'string': query, 'status': 'error', 'message': {quoted(v.NOTHING_FOUND)}}})"
JSON = f"""SELECT query_id, coalesce((rank - 1) // {{size}}, 0) AS document,
  max(coalesce((max(rank) - 1) // {{size}}, 0)) OVER (PARTITION BY query_id) + 1 AS documents,
  cast(CASE WHEN count(key) = 0 THEN {ERROR} ELSE {SUCCESS} END AS varchar) AS json
  FROM queries LEFT JOIN ranked USING (query_id) GROUP BY query_id, query, document"""

PUTS = """puts AS (
  SELECT cast(doc_id AS varchar) AS Id, 1 AS sequence, NULL AS Title, NULL AS Text,
         concat('quality ', quality) AS Categories, NULL AS Infobox, NULL AS External_Links FROM labels
  UNION ALL
  SELECT cast(doc_id AS varchar), 2, NULL, NULL, NULL, concat('toxic ', toxic), NULL FROM labels
  UNION ALL
  SELECT concat('conversation-', conv_id), turn, role, text, NULL, NULL, NULL FROM conversations)"""
LAST_PUTS = "last_puts AS (SELECT Id, " + ", ".join(
    f"arg_max({c}, sequence) FILTER ({c} IS NOT NULL) AS {c}" for c in v.FIELDS
) + " FROM puts GROUP BY Id)"
UPSERTED = "SELECT Id, " + ", ".join(
    f"coalesce(n.{c}, o.{c}) AS {c}" for c in v.FIELDS
) + " FROM fielded o FULL JOIN last_puts n USING (Id)"

WIKI_LOOKUP = """lookup_words AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zA-Z0-9]+')) AS Word FROM conversations)"""


def statements() -> dict[str, str]:
    sql = {
        "xml_page_scan": statement([WIKI], "SELECT Id, Title, Text FROM wiki"),
        "xml_split_scan": statement([WIKI], "SELECT Id, Title, Text FROM wiki"),
        "page_initial_capitals": statement(
            [WIKI],
            f"SELECT Id, {initial_capitals('Title')} AS Title, {initial_capitals('Text')} AS Text FROM wiki",
        ),
        "page_sample": statement(
            [WIKI], "SELECT Id, Title, Text FROM wiki ORDER BY cast(Id AS BIGINT) LIMIT 20"
        ),
        "normalize_case": statement([WIKI, CASED], "SELECT Id, Title, Text FROM cased"),
        "clean_body_sequential": statement([WIKI, CASED, cleaned()], "SELECT Id, Text FROM cleaned"),
        "clean_body_single_pass": statement(
            [WIKI, CASED, cleaned(single_pass)], "SELECT Id, Text FROM cleaned"
        ),
        "clean_html_pages": f"SELECT page_id, {sequential('lower(html)')} AS Text FROM pages",
        "extract_categories": statement(
            [WIKI, CASED, cleaned(), BOXED],
            "SELECT Id, coalesce(array_to_string(Categories, chr(10)), '') AS Categories FROM boxed",
        ),
        "extract_infobox": statement(
            [WIKI, CASED, cleaned(), BOXED], "SELECT Id, Infobox, Remaining_Text FROM boxed"
        ),
        "extract_external_links": statement(
            DOCUMENTS[:-1], "SELECT Id, External_Links FROM parted"
        ),
        "extract_body": statement(DOCUMENTS[:-1], "SELECT Id, Text FROM parted"),
        "extract_body_kept": statement(
            DOCUMENTS[:-1],
            """SELECT Id, CASE WHEN contains(Remaining_Text, 'external links') THEN Text
                 ELSE Remaining_Text END AS Text FROM parted""",
        ),
        "strip_junk": statement(
            DOCUMENTS[:-1],
            f"""SELECT Id, {replace('Title', JUNK, ' ')} AS Title, {junk('Text')} AS Text,
                 {junk('External_Links')} AS External_Links FROM parted""",
        ),
        "clean_categories": statement(
            DOCUMENTS[:-1], f"SELECT Id, coalesce({CATEGORY_NAMES}, '') AS Categories FROM parted"
        ),
        "extract_infobox_nested": NESTED,
        "clean_infobox": statement(
            DOCUMENTS[:-1],
            f"SELECT Id, {replace('Infobox', '[^a-zA-Z0-9_]', ' ')} AS Infobox FROM parted",
        ),
        "squeeze_whitespace": statement(
            DOCUMENTS, "SELECT Id, Title, Text, Infobox, External_Links FROM fielded"
        ),
        "field_documents": statement(DOCUMENTS, f"SELECT Id, {FIELD_COLUMNS} FROM fielded"),
        "field_documents_single_pass": statement(
            [WIKI, CASED, cleaned(single_pass), BOXED, PARTED, FIELDED],
            f"SELECT Id, {FIELD_COLUMNS} FROM fielded",
        ),
        "tokenize_fields": statement(DOCUMENTS, f"SELECT Id, {NOT_EMPTY} FROM fielded"),
        "stop_words_index": statement(DOCUMENTS, f"SELECT Id, {NOT_STOPPED} FROM fielded"),
        "term_doc_outer_merge": statement(PLAIN, f"SELECT Id, Word, {FIELD_COLUMNS} FROM counts"),
        "field_term_counts": statement(PLAIN, f"SELECT Id, Word, {FIELD_COLUMNS} FROM counts"),
        "inverted_index": statement(
            [*PLAIN, *postings()], "SELECT Word, segment, documents, doc_ids FROM postings"
        ),
        "inverted_index_segments": statement(
            [*PLAIN, *postings(40)], "SELECT Word, segment, documents, doc_ids FROM postings"
        ),
        "posting_strings": statement(
            [*PLAIN, *postings()], "SELECT Word, segment, Document_Counts FROM postings"
        ),
        "decode_postings": statement(
            PLAIN,
            """SELECT Word, Id AS doc_id, Title AS title, Text AS text, Categories AS categories,
                 Infobox AS infobox, External_Links AS external_links FROM counts""",
        ),
        "posting_scores": statement(PLAIN, f"SELECT Word, Id AS doc_id, {SCORE} AS score FROM counts"),
        "index_stats": statement(
            PLAIN,
            f"""SELECT count(DISTINCT Word) AS words,
                 count(DISTINCT Word) // {v.BATCH_SIZE} + 1 AS planned_batches,
                 cast(ceil(count(DISTINCT Word) / {v.BATCH_SIZE}) AS BIGINT) AS written_batches FROM counts""",
        ),
        "vocabulary_rank": statement([*PLAIN, VOCABULARY], "SELECT Word, rank FROM vocabulary"),
        "index_batches": statement(
            [*PLAIN, VOCABULARY, BATCHES], "SELECT Word, batch AS Batch_Number FROM batches"
        ),
        "secondary_index": statement(
            [*PLAIN, VOCABULARY, BATCHES, SECONDARY], "SELECT batch, first_word FROM secondary"
        ),
        "secondary_index_text": statement(
            [*PLAIN, VOCABULARY, BATCHES, SECONDARY], "SELECT first_word AS value FROM secondary"
        ),
        "union_first_words": statement(
            [*PLAIN, VOCABULARY, BATCHES, SECONDARY, *QUERY_TERMS],
            """SELECT first_word FROM secondary
               UNION ALL SELECT min(Word) AS first_word FROM terms GROUP BY query_id""",
        ),
        "index_write_roundtrip": statement([*PLAIN, *postings(), VOCABULARY, BATCHES], INDEX_ROWS),
        "secondary_lookup": statement(
            [*PLAIN, VOCABULARY, BATCHES, SECONDARY, WIKI_LOOKUP],
            """SELECT Word, max(batch) AS batch FROM lookup_words JOIN secondary ON first_word <= Word
               GROUP BY Word""",
        ),
        "query_terms": statement(QUERY_TERMS, "SELECT query_id, Word, repeats FROM terms"),
        "query_terms_stemmed": statement(
            STEMMED_QUERY_TERMS, "SELECT query_id, Word, repeats FROM terms"
        ),
        "index_term_lookup": statement([*PLAIN, *postings(), *QUERY_TERMS], HITS),
        "search_scores": statement(
            [*PLAIN, *QUERY_TERMS, SCORES], "SELECT query_id, key, score FROM scores"
        ),
        "search_ranked": statement(
            [*PLAIN, *QUERY_TERMS, SCORES, RANKED], "SELECT query_id, key, score, rank FROM ranked"
        ),
        "search_listing": statement(
            [*PLAIN, *QUERY_TERMS, SCORES, RANKED],
            f"""SELECT query_id, coalesce(rank, 0) AS rank, CASE WHEN rank IS NULL
                THEN {quoted(v.NOTHING_FOUND)} ELSE key || ' ' || score END AS line
                FROM queries LEFT JOIN ranked USING (query_id)""",
        ),
        "search_result_json": statement(
            [*PLAIN, *QUERY_TERMS, SCORES, RANKED], JSON.replace("{size}", "100000")
        ),
        "search_result_json_parts": statement(
            [*PLAIN, *QUERY_TERMS, SCORES, RANKED], JSON.replace("{size}", "100")
        ),
        "stem_vocabulary": statement(
            [*DOCUMENTS, FIELD_WORDS, KEPT, *stems("kept")], "SELECT Word, Stem FROM stems"
        ),
        "stemmed_term_counts": statement(STEMMED, f"SELECT Id, Word, {FIELD_COLUMNS} FROM counts"),
        "stemmed_index_roundtrip": statement([*STEMMED, *postings(), VOCABULARY, BATCHES], INDEX_ROWS),
        "stemmed_search_ranked": statement(
            [*STEMMED, *STEMMED_QUERY_TERMS, SCORES, RANKED],
            "SELECT query_id, key, score, rank FROM ranked",
        ),
        "word_count_docs": r"""SELECT word, count(*) AS count FROM (
            SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "word_count_output": r"""SELECT word || chr(9) || count(*) AS value FROM (
            SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "keyed_create": statement(DOCUMENTS, f"SELECT Id, {FIELD_COLUMNS} FROM fielded"),
        "keyed_sink": statement(DOCUMENTS, f"SELECT Id, {FIELD_COLUMNS} FROM fielded"),
        "upsert_documents": statement([*DOCUMENTS, PUTS, LAST_PUTS], UPSERTED),
        "keyed_encode": statement(
            DOCUMENTS,
            "SELECT hex(encode(Id)) AS Id, " + ", ".join(f"hex(encode({f})) AS {f}" for f in v.FIELDS)
            + " FROM fielded",
        ),
    }
    for field in v.FIELDS:
        sql[f"tf_{field.lower()}"] = statement(
            PLAIN, f"SELECT Id, Word, {field} FROM counts WHERE {field} > 0"
        )
    return sql
