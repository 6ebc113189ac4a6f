"""Secret scans: candidate strings, and a random forest that tells secrets from the rest.

A candidate is a run of 16 or more letters, digits and a few signs, or what is assigned to a key
word (``password = ...``, ``"token": "..."``), of any length and signs. Its features are its
length, how often its characters change class, how much of it a dictionary covers, whether it
stands in a path, and the words around it. The dictionary is made of the corpus itself: all
runs of four letters of the words that are frequent in it. The forest is trained on findings
that somebody has labelled; what it rejects are false positives.
"""

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import stored

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
SAMPLE = 20_000  # labelled findings that are learned from, at most
FREQUENT = 5  # times a word occurs that counts as one of the language
GRAM = 4

# Words that often stand before secrets, and before other strings of their kind.
KEY_WORDS = r"(?i)(passw|passwd|pwd|secret|token|api|key|auth|credential|bearer|login)"
OTHER_WORDS = r"(?i)(sha|md5|hash|commit|checksum|uuid|digest|example|sample|dummy|test|card|phone)"

# What is assigned to a key word: from an opening quote to the closing one, or to the end of the
# word or the next name and sign of a query string. Possessive, as words may be very long.
IS = r"[\w.\-]{0,64}+[\\\"'`\])]*+\s*+(?>=>|:=|==?+|:)"
ASSIGNS = rf"(?i)(?:pass|pwd|secret|token|api|key|auth|credential|bearer|login){IS}"
PASSWORD = rf"(?i)(?:pass|pwd){IS}"
NEXT = r"[&;,?][\\\"'`]*+[\w.\-]{1,64}+[\\\"'`]*+[=:]"
VALUE = (
    rf"{ASSIGNS}\s*+(?:(?:bearer|basic)\s++)?+"
    rf"(\\?+\"[^\"\s]++|\\?+'[^'\s]++|`[^`\s]++|(?:(?!{NEXT})[^\s\"'`])(?:(?!{NEXT})\S)*+)(?=\S*+$)"
)

OPENS = r"\s*+(?:(?:bearer|basic)\s++)?+[\\\"'`]*+$"  # stands between the sign and the value
# Keys that their form alone tells: of clouds, code hosts, chats, payment and the like.
KNOWN = (
    r"^(?:(?:AKIA|ASIA)[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}"
    r"|glpat-[A-Za-z0-9_-]{20,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|(?:sk|rk|pk)_live_[A-Za-z0-9]{16,}"
    r"|sk-[A-Za-z0-9_-]{20,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z0-9]{30,}"
    r"|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_.-]{10,})$"
)

FEATURES = [
    "length", "changes", "digits", "capitals", "distinct", "vowels", "hexadecimal", "coverage",
    "in_path", "in_url", "assigned", "quoted", "key_word", "other_word", "in_front", "behind",
]


def assigned(near: Column) -> Column:
    """What is assigned to key words in the last word of ``near``, without quotes around it.

    Signs at the end that close a sentence or bracket do not count where no quote opens.
    """
    found = F.regexp_extract_all(near, F.lit(VALUE), 1)
    quoted = r"^\\?[\"'`]"
    bare = F.transform(
        found,
        lambda v: F.when(v.rlike(quoted), F.regexp_replace(F.regexp_replace(v, quoted, ""), r"\\+$", "")).otherwise(
            F.regexp_replace(v, r"[\"'`)\]}>,;.]++$", "")
        ),
    )
    return F.array_distinct(F.filter(bare, lambda v: v != ""))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, word_no, candidate, word, before, after``: a row for each candidate, with the
    word it stands in, two words before it and one behind. A run that is assigned as a whole
    has one row; of what is assigned with blanks in it the first word counts."""
    text = F.col(text_col).cast("string")
    # Most texts hold none and are not cut into words.
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(ASSIGNS))
    rows = rows.select("doc_id", F.split("text", r"[\x20\x09-\x0D]+").alias("words"))

    def before(i: Column) -> Column:
        two, one = F.when(i > 1, F.get("words", i - 2)), F.when(i > 0, F.get("words", i - 1))
        return F.concat_ws(" ", two, one)

    def around(i: Column) -> Column:
        return F.struct(
            i.cast("bigint").alias("word_no"),
            F.get("words", i).alias("word"),
            before(i).alias("before"),
            F.coalesce(F.get("words", i + 1), F.lit("")).alias("after"),
        )

    def holds(i: Column) -> Column:
        return F.get("words", i).rlike(CANDIDATE) | F.concat_ws(" ", before(i), F.get("words", i)).rlike(VALUE)

    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), holds)
    found = rows.select("doc_id", F.explode(F.transform(places, around)).alias("at")).select("doc_id", "at.*")
    runs = F.regexp_extract_all("word", F.lit(CANDIDATE), 0)
    given = assigned(F.concat_ws(" ", "before", "word"))
    found = found.select("*", F.explode(F.concat(runs, F.array_except(given, runs))).alias("candidate"))
    return found.select("doc_id", "word_no", "candidate", "word", "before", "after")


def grams(text: Column) -> Column:
    """The distinct runs of ``GRAM`` letters of a text in lower case."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(plain) - GRAM + 1))
    found = F.transform(starts, lambda i: F.substring(plain, i, F.lit(GRAM)))
    return F.array_distinct(F.filter(found, lambda g: (F.length(g) == GRAM) & ~g.contains(" ")))


def dictionary(docs: DataFrame, text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``gram``: the letter runs of the words that occur ``frequent`` times or more."""
    found = F.split(F.lower(F.col(text_col).cast("string")), r"[^\p{L}]+")
    said = docs.select(F.explode(F.filter(found, lambda w: F.length(w).between(GRAM, 20))).alias("word"))
    counts = said.groupBy("word").count().where(F.col("count") >= frequent)
    return counts.select(F.explode(grams(F.col("word"))).alias("gram")).distinct()


def covered(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with ``coverage``, the share of their characters' runs that are known."""
    each = found.select("candidate").distinct()
    pieces = each.select("candidate", F.explode_outer(grams(F.col("candidate"))).alias("gram"))
    marked = pieces.join(known.withColumn("known", F.lit(1)), "gram", "left")
    sums = marked.groupBy("candidate").agg(F.sum(F.coalesce("known", F.lit(0))).alias("n"))
    share = F.col("n") / F.greatest(F.lit(1), F.length("candidate") - GRAM + 1)
    return found.join(sums.select("candidate", share.alias("coverage")), "candidate", "left")


def described(found: DataFrame) -> DataFrame:
    """The candidates with ``features``, in the order of ``FEATURES``."""
    text, length = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / length

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    change = "(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]|[+/_=-]"
    at = F.instr("word", text)
    front, behind = F.substr(F.col("word"), F.lit(1), at - 1), F.substr(F.col("word"), at + length)
    near = F.concat_ws(" ", "before", front)
    values = {
        "length": length.cast("double"),
        "changes": share(change),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(text, ""))) / length,
        "vowels": share("(?i)[aeiou]"),
        "hexadecimal": share("[0-9a-fA-F]"),
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "in_path": flag(text.contains("/") | front.endswith("/") | behind.startswith("/")),
        "in_url": flag(F.col("word").contains("://")),
        "assigned": flag(near.rlike(r"[=:]\W*$")),
        "quoted": flag(F.concat(front, behind).rlike("[\"'`]")),
        "key_word": flag(near.rlike(KEY_WORDS)),
        "other_word": flag(F.concat_ws(" ", near, "after").rlike(OTHER_WORDS)),
        "in_front": F.length(front).cast("double"),
        "behind": F.length(behind).cast("double"),
    }
    whole = array_to_vector(F.array(*[values[n].cast("double") for n in FEATURES]))
    return found.withColumn("__features", whole)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | float:
    """A forest from described findings with ``label`` 0 or 1, or their rate if all agree.

    Each label's findings are learned from once per distinct string; of each label the half of
    ``sample`` with the smallest hash are taken, so that a rare label is not lost.
    """
    rows = labelled.where("label in (0, 1)").groupBy("candidate", F.col("label").cast("double").alias("label"))
    rows = rows.agg(F.first("__features").alias("__features"))
    rows = stored(rows)
    half = max(1, sample // 2)
    no, yes = (rows.where(F.col("label") == n).orderBy(F.xxhash64("candidate"), "candidate").limit(half) for n in (0, 1))
    rows = stored(no.unionByName(yes).coalesce(4))
    rate = rows.agg(F.avg("label")).first()[0] or 0.0
    if rate in (0.0, 1.0):
        return rate
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__class",
        probabilityCol="__probability", rawPredictionCol="__votes", numTrees=20, maxDepth=6, seed=1,
    )
    return forest.fit(rows)


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, word_no, candidate, word, score, is_secret`` for every candidate.

    ``findings`` has ``candidate`` and ``label`` (1 secret, 0 false positive); labels are of
    the string, wherever it stands. Without it, or without both labels, every score is the
    rate of secrets among the labels (0 without any). ``word_no`` counts from 0, ``word`` is
    what the candidate stands in. Null and empty texts hold no candidates; of several in a
    word each has a row, and so has each of repeated rows. Null ids stay null. Other columns
    play no part.
    """
    found = covered(candidates(docs, id_col, text_col), dictionary(docs, text_col))
    found = described(found).withColumn("__features", vector_to_array("__features"))
    found = stored(found).withColumn("__features", array_to_vector("__features"))
    if findings is None:
        findings = labelled_by_format(found)
    labels = findings.select(F.col("candidate").alias("__candidate"), "label").distinct()
    model = fit(found.join(labels, F.col("candidate") == F.col("__candidate")), sample)
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("__probability")[1])
    return scored.select(
        "doc_id", "word_no", "candidate", "word", "score", (F.col("score") >= 0.5).alias("is_secret")
    )


def labelled_by_format(found: DataFrame) -> DataFrame:
    """Findings whose kind their format shows: keys of known form, the first line of a private
    key, and what is assigned to a key word if it is a digest, a random string, or a password
    of several kinds of signs; against them plain words and plain numbers. The rest stays
    open, as do plain words and numbers that are assigned to a password."""
    text, front = F.col("candidate"), F.concat_ws(" ", "before", "word")
    # All that stands before the candidate; the word ends in it where nothing follows.
    at = F.instr("word", text)
    ahead = F.concat_ws(" ", "before", F.substr(F.col("word"), F.lit(1), F.greatest(F.lit(0), at - 1)))
    key = text.rlike(KNOWN)
    block = ahead.rlike(r"PRIVATE KEY-----\W*$") & text.rlike("^[A-Za-z0-9+/]{40,}={0,2}$")
    digest = text.rlike("^[0-9a-f]{16,64}$") & text.rlike("[a-f]") & front.rlike(r"(?i)(password|token)\s*=")
    after_key, after_password = ahead.rlike(f"{ASSIGNS}{OPENS}"), ahead.rlike(f"{PASSWORD}{OPENS}")
    kinds = sum((text.rlike(k).cast("int") for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")), F.lit(0))
    random = after_key & text.rlike("^[A-Za-z0-9+/_-]{20,}={0,2}$") & text.rlike("[a-z]") & text.rlike("[A-Z].*[0-9]|[0-9].*[A-Z]")
    chosen = after_password & (F.length(text) >= 6) & (kinds >= 2) & ~text.rlike("^[A-Z]?[a-z]+[^A-Za-z0-9]?$")
    plain = text.rlike("^[A-Za-z]?[a-z]+$") | text.rlike("^[0-9]+$")
    label = F.when(key | block | digest | random | chosen, 1).when(plain & ~after_password, 0)
    return found.select("candidate", label.alias("label")).where("label is not null").distinct()


def redacted(scanned: DataFrame) -> DataFrame:
    """Findings without the secrets themselves: their length, beginning and digest. The
    beginning is a quarter of a finding and four letters at most."""
    shown = F.least(F.lit(4), F.floor(F.length("candidate") / 4)).cast("int")
    return scanned.select(
        "doc_id", "word_no", F.length("candidate").alias("length"),
        F.concat(F.substr("candidate", F.lit(1), shown), F.lit("…")).alias("begins"),
        F.sha2("candidate", 256).alias("sha256"), "score", "is_secret",
    )
