"""They decide the results, so they are stated once, here.

Patterns use possessive quantifiers (``*+``) where giving characters back could
never lead to a match; that keeps one attempt linear on long bodies.
"""

# --- fixed values: fields ---------------------------------------------------
FIELDS = ["Title", "Text", "Categories", "Infobox", "External_Links"]

# --- fixed values: markup patterns (on lower-cased text) --------------------
CITE = r"\{\{(?:cite|vcite)\s[^\}]*+\}\}"
PUNCTUATION = r"[.,;_()/\"'=]"
FILE_LINK = r"\[\[file:[^\]]*+\]\]"
TAG = r"<[^>]*+>"
NON_ASCII = r"[^\x00-\x7F]+"
CATEGORY = r"\[\[category:(.*?)\]\]"
JUNK = r"[~`!@#$%\-^*+{}\[\]|\\<>/?,:&]"
NOT_WORD_CHARACTER = r"[^a-zA-Z0-9_]"
QUERY_WORD = r"[a-zA-Z0-9]+"

# --- fixed values: landmarks in the text ------------------------------------
INFOBOX_OPEN = "{{infobox"
LINKS_HEADING = "external links"
CATEGORY_OPEN = "[[category"

# --- fixed values: index layout ---------------------------------------------
BATCH_SIZE = 500
POSTING_SEPARATOR = "#"
ID_SEPARATOR = ":"
COUNT_SEPARATOR = "-"

# --- fixed values: score weights --------------------------------------------
WEIGHTS = {
    "title": 500,
    "text": 1,
    "infobox": 50,
    "categories": 50,
    "external_links": 50,
    "base": 50,
}

# --- fixed values: result messages ------------------------------------------
NOTHING_FOUND = "Không tìm thấy kết quả nào!"

# White space as Python's str.strip() sees it.
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# White space as the regex class \s sees it.
REGEX_SPACE = " \t\n\x0b\x0c\r"

# --- fixed values: stop words dropped from queries (179) --------------------
QUERY_STOP_WORDS = """
a about above after again against ain all am an and any are aren aren't as at
be because been before being below between both but by
can couldn couldn't d did didn didn't do does doesn doesn't doing don don't down during
each few for from further had hadn hadn't has hasn hasn't have haven haven't having
he her here hers herself him himself his how i if in into is isn isn't it it's its itself
just ll m ma me mightn mightn't more most mustn mustn't my myself
needn needn't no nor not now o of off on once only or other our ours ourselves out over own
re s same shan shan't she she's should should've shouldn shouldn't so some such
t than that that'll the their theirs them themselves then there these they this those through to too
under until up ve very was wasn wasn't we were weren weren't what when where which while who whom why
will with won won't wouldn wouldn't y you you'd you'll you're you've your yours yourself yourselves
""".split()

# --- fixed values: stop words dropped from the index ------------------------
# Spark's own English list (181), as StopWordsRemover.loadDefaultStopWords("english") gives it.
INDEX_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such
no nor not only own same so than too very s t can will just don should now
i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd
i'm you're he's she's it's we're they're i've we've you've they've
isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could
here's how's let's ought that's there's what's when's where's who's why's would
""".split()
