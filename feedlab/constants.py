"""Values that must equal the source feed jobs' for the results to agree.

Everything else in the library (operators, plans, partitioning) is its own
design; only the values below are taken from the source jobs.
"""

# ---------------------------------------------------------------------------
# Fixed values (as in the source jobs), in pipeline order.
# ---------------------------------------------------------------------------

# delimited exports
FIELD_SEP = "\t"                 # fields of a line
MISSING = "-"                    # marker of an empty / missing field
ID_PREFIX_LEN = 2                # raw uid / urlid carry a 2-character prefix
IMPRESSION_FIELDS = ("label", "ts", "uid", "urlid", "urlinfo")  # joined export, first 4 commas split
URLINFO_FIELDS = ("utype", "url", "title", "s_title", "pnum", "pdef", "pbeau", "ppoint", "tpoint", "s_content")
MISSING_NUMBER = -1              # pnum / pdef / pbeau of a malformed page row
RAW_IMPRESSION_FIELDS = ("uid", "urlid", "ts", "label")          # impression export, prefixed ids
RAW_PAGE_FIELDS = ("urlid", "utype", "url", "title", "pnum", "pdef", "pbeau", "ppoint", "tpoint", "tcontent")

# term lists
TERM_ITEM_SEP = ","              # "k:v,k:v" (title / content keywords, vectors, profiles)
POINT_ITEM_SEP = ";"             # "k:v;k:v" (weighted point terms)
TERM_KV_SEP = ":"
TAG_SEP = ","                    # "k,k" (tag terms, weight 1 each)

# keywords, profiles, tokens
TITLE_KEYWORDS = 20
CONTENT_KEYWORDS = 40
PROFILE_TOP_N = 21
TOKEN_TRUNCATE = 10

# feature vectors
VECTOR_ORDER = ("ctr", "pnum", "pdef", "pbeau", "s_term_score", "sumclick", "sumshow")
JSON_VECTOR_ORDER = ("ts_interval", "p_num", "p_defination", "p_beauty", "title_term_score",
                     "url_whole_term_score")

# models
LR_MAX_ITER, LR_REG, LR_ENET = 30, 0.3, 0.1
LR_TABLE_MAX_ITER, LR_TABLE_REG, LR_TABLE_ENET = 500, 0.2, 0.8
TREE_DEPTH = 5
FOREST_TREES = 10
SUBSAMPLE = 0.7
CHI2_TOP_FEATURES = 3
ALS_MAX_ITER, ALS_REG, ALS_USER_BLOCKS, ALS_ITEM_BLOCKS = 10, 0.01, 20, 100
ALS_TOP_K = 10
TRAIN_SPLIT_ALS = (0.8, 0.2)
TRAIN_SPLIT_CLASSIFIER = (0.99, 0.01)   # 0.9 / 0.1 in the development job

# embeddings
W2V_SIZE = 128                   # 16 in the smaller job
W2V_MIN_COUNT = 2
W2V_PARTITIONS = 8               # training shards: part of the model, so not taken from the cluster (own value)
SYNONYMS_K = 5
SIMILARITY_DIGITS = 5

# threshold search
THRESHOLD_TOLERANCE = 1e-5

# default stop words: the English list of Spark MLlib's StopWordsRemover (181 words)
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())
