"""Toxicity: boosted trees over dense features of the text, calibrated by isotonic regression.

The labelled rows are split four ways by the checksum of their id. From a half of them a
lexicon is learned: words, and their beginnings, that occur in far more toxic than clean
documents, counted by distinct documents so that copies don't count twice. It describes the
other half, so that no row is described by words found in itself; on one part of each half
the trees are fitted, on the other the calibration. New texts are described by the lexicon of
all four parts. They are scored where they lie; nothing but the model moves.
"""

import math
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import short_batches, stored

SAMPLE = 24_000  # labelled documents that are learned from, at most
CANDIDATES = 20_000  # stems that are weighed, at most; those in most labelled documents
LEXICON = 5_000  # stems that are kept, at most; the model travels to every task
NEAR, SPAN = 5, 50  # words
WORDS = 200_000  # words that a task remembers the codes of

# Second-person words, and signs that stand for letters.
SECOND_PERSON = {
    "you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "tú", "ti", "tuyo", "usted", "ustedes",
}
SIGNS = str.maketrans("013457@$!|", "oieastasil")

NAMES = [
    "hits", "hit_weight", "largest_weight", "hit_count", "densest_span", "near_second_person",
    "second_person", "capitals", "shouted", "exclamations", "questions", "punctuation", "digits",
    "disguised_hits", "mixed_words", "length", "word_length",
]

EDGES = string.punctuation + "«»„“”‘’…–—¡¿"
INNER = re.compile(r"[\W_]+")
LONG_RUN = re.compile(r"(.)\1{2,}")
CAPITALS = bytes(range(65, 91))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def plain(word: str) -> str:
    return word.strip(EDGES).lower()


def undisguised(word: str) -> str:
    """Signs read as letters, separators taken out, long runs of a letter cut to one."""
    word = word.lower().strip("!?.,;:()'\"")
    return LONG_RUN.sub(r"\1", INNER.sub("", word.translate(SIGNS)))


def stems(word: str) -> list[str]:
    """The word itself, and its beginnings if it is longer."""
    return [f"={word}", *(word[:n] for n in (4, 5, 6) if len(word) > n)] if word else []


class Codes(dict):
    """A word's flags (second person 1, shouted 2, disguised 4, mixed 8), and its weight above."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        # As over ``stems``, without making a list for each new word.
        known = self.lexicon.get
        best = known("=" + word, 0.0)
        for n in (4, 5, 6):
            if len(word) > n:
                best = max(best, known(word[:n], 0.0))
        return best

    def __missing__(self, raw: str) -> int:
        word = plain(raw)
        letters = word.isalpha()
        weight, disguised = self.weight(word), 0
        if not weight and (not letters or LONG_RUN.search(word)):
            weight = self.weight(undisguised(raw))
            disguised = 4 if weight else 0
        shouted = 2 if len(word) > 2 and raw.isupper() else 0
        mixed = 8 if not letters and any(c.isalpha() for c in word) else 0
        code = (word in SECOND_PERSON) | shouted | disguised | mixed | int(weight * 64) << 4
        if len(self) >= WORDS:
            self.clear()
        self[raw] = code
        return code


def described(text: str | None, codes: Codes) -> list[float]:
    """The features in the order of ``NAMES``; all 0 for null and empty texts."""
    found = [0.0] * len(NAMES)
    words = text.split() if text else []
    if not words:
        return found
    n = len(words)
    code = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=n)
    weight = (code >> 4) / 64
    hits = np.flatnonzero(weight)
    person = np.flatnonzero(code & 1)
    raw = text.encode("utf-8", "surrogatepass")
    size = len(raw)
    if len(hits):
        found[0:4] = [len(hits) / n, weight.sum() / n, weight.max(), math.log1p(len(hits))]
        within = np.searchsorted(hits, hits + SPAN) - np.arange(len(hits))
        found[4] = within.max() / min(n, SPAN)
        found[13] = np.count_nonzero(code[hits] & 4) / n
        if len(person):
            at = np.searchsorted(person, hits)
            after = np.abs(person[np.minimum(at, len(person) - 1)] - hits)
            before = np.abs(hits - person[np.maximum(at - 1, 0)])
            found[5] = (np.minimum(after, before) <= NEAR).mean()
    found[6] = len(person) / n
    found[7] = (size - len(raw.translate(None, CAPITALS))) / size
    found[8] = np.count_nonzero(code & 2) / n
    found[9], found[10] = raw.count(b"!") / size, raw.count(b"?") / size
    found[11] = (size - len(raw.translate(None, MARKS))) / size
    found[12] = (size - len(raw.translate(None, b"0123456789"))) / size
    found[14] = np.count_nonzero(code & 8) / n
    found[15], found[16] = math.log1p(n), size / n
    return [float(x) for x in found]


def with_features(docs: DataFrame, text_col: str, lexicon: dict[str, float], carry: list[str]) -> DataFrame:
    """The carried columns, and ``__features``. The text may be a field of a carried struct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lexicon)
        for batch in batches:
            texts = pc.struct_field(batch.column(name), field) if field else batch.column(name)
            values = [described(t.as_py(), codes) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(values, pa.list_(pa.float64()))],
                names=[*carry, "__features"],
            )

    short_batches(docs.sparkSession)
    # A text that is carried anyway goes to the task once.
    name, _, field = text_col.partition(".")
    name = name if name in carry else "__text"
    given = docs.select(*carry)
    if name not in carry:
        given = docs.select(*carry, F.col(text_col).cast("string").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema]
    found = given.mapInArrow(run, ", ".join([*fields, "__features array<double>"]))
    return found.withColumn("__features", array_to_vector("__features"))


def in_documents(wanted: set[str] | None):
    """Each stem of a document with a number that copies of the document share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, int]] = []
            for text in batch.column(0):
                words = [plain(w) for w in (text.as_py() or "").split()]
                threes = zip(words, words[1:], words[2:])
                like = min((zlib.crc32(" ".join(t).encode("utf-8", "replace")) for t in threes), default=0)
                own = {s for w in set(words) for s in stems(w)}
                rows += [(s, like) for s in (own if wanted is None else own & wanted)]
                rows.append(("", like))
            columns = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.int64()))],
                names=["stem", "like"],
            )

    return run


def learned_lexicon(
    sample: DataFrame, candidates: int = CANDIDATES, lexicon: int = LEXICON
) -> dict[str, float]:
    """Log odds of stems that toxic documents (``text, toxic``) have far more often."""

    def counted(rows: DataFrame, wanted: set[str] | None, least: int) -> dict[str, int]:
        found = rows.select("text").mapInArrow(in_documents(wanted), "stem string, like bigint")
        counts = found.groupBy("stem").agg(F.countDistinct("like").alias("n"))
        top = counts.where(f"n >= {least} or stem = ''").orderBy(F.desc("n"), "stem").limit(candidates + 1)
        return {r.stem: r.n for r in top.collect()}

    toxic, clean = sample.where("toxic = 1"), sample.where("toxic = 0")
    in_toxic = counted(toxic, None, 3)
    total_toxic = in_toxic.pop("", 0)
    least = max(3, total_toxic // 150)
    in_toxic = {s: n for s, n in in_toxic.items() if n >= least}
    in_clean = counted(clean, set(in_toxic), 1)
    total_clean = in_clean.pop("", 0)
    weights = {
        s: math.log((n + 0.5) / (total_toxic + 1)) - math.log((in_clean.get(s, 0) + 0.5) / (total_clean + 1))
        for s, n in in_toxic.items()
    }
    best = sorted((w for w in weights.items() if w[1] >= 2), key=lambda w: (-in_toxic[w[0]] * w[1], w[0]))
    return dict(best[:lexicon])


@dataclass
class Model:
    """What scores a text: lexicon, trees and calibration, or one rate for all."""

    lexicon: dict[str, float]
    trees: object = None
    calibration: object = None
    rate: float = 0.0

    def score(self, docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
        """The carried columns with ``__score`` from 0 to 1."""
        if self.trees is None:
            return docs.select(*carry, F.lit(self.rate).alias("__score"))
        found = raw_scores(self.trees, with_features(docs, text_col, self.lexicon, carry))
        found = self.calibration.transform(found)
        # A trace of the trees' own score keeps the order within a step of the calibration.
        score = 0.999 * F.col("__calibrated") + 0.001 * F.col("__raw")
        return found.select(*carry, F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("__score"))


def raw_scores(trees, features: DataFrame) -> DataFrame:
    found = trees.transform(features)
    return found.withColumn("__raw", vector_to_array("__probability")[1])


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    candidates: int = CANDIDATES,
    lexicon: int = LEXICON,
) -> Model:
    """Learns from labelled rows with ``remainder`` 1 to 4, at most ``sample`` of them: those
    with the smallest hash of the id. Repeated labels of an id count as toxic if one is. The
    lexicon has ``lexicon`` stems at most, out of the ``candidates`` most frequent ones."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (remainder(id_col) != 0))
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    # At most ``sample`` rows of an id and a label.
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), "__id").withColumn("part", remainder("__id").cast("int"))
    rows = stored(rows)
    counts = {(r.part, r.toxic): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
    total = sum(counts.values())
    rate = sum(n for (_, toxic), n in counts.items() if toxic) / total if total else 0.0
    if any(not sum(counts.get((p, toxic), 0) for p in parts) for parts in ((1, 3), (2, 4)) for toxic in (0, 1)):
        return Model({}, rate=rate)

    def described_by(learned: str, others: str) -> DataFrame:
        stems = learned_lexicon(rows.where(learned), candidates, lexicon)
        found = with_features(rows.where(others).coalesce(8), "text", stems, ["part", "toxic"])
        found = found.withColumn("__features", vector_to_array("__features"))
        return found.withColumn("toxic", F.col("toxic").cast("double"))

    one, two = "part in (1, 2)", "part in (3, 4)"
    features = stored(described_by(one, two).unionByName(described_by(two, one)))
    features = features.withColumn("__features", array_to_vector("__features"))
    boosting = GBTClassifier(
        featuresCol="__features", labelCol="toxic", predictionCol="__class",
        maxIter=20, maxDepth=3, stepSize=0.3, seed=1,
    ).setProbabilityCol("__probability").setRawPredictionCol("__margin")
    trees = boosting.fit(features.where("part in (1, 3)").coalesce(2))
    calibration = IsotonicRegression(featuresCol="__raw", labelCol="toxic", predictionCol="__calibrated").fit(
        raw_scores(trees, features.where("part in (2, 4)").coalesce(2)).select("__raw", "toxic")
    )
    return Model(learned_lexicon(rows, candidates, lexicon), trees, calibration)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    candidates: int = CANDIDATES,
    lexicon: int = LEXICON,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every input row.

    Only the text enters a score. ``held_out`` rows (the checksum of the id, modulo 5, is 0)
    are never learned from; labels other than 0 and 1, and those without an id, play no part.
    Null and empty texts are scored as texts without any feature. With too few labels, one
    class missing in a part, every score is the rate of toxic labels (0 without any). Repeated
    rows get a row each. A null id is not held out. Other columns play no part.
    """
    model = fit(docs, labels, id_col, text_col, label_col, sample, candidates, lexicon)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return model.score(given, "text", ["doc_id"]).select(
        "doc_id",
        F.coalesce(remainder("doc_id") == 0, F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        F.when(F.col("__score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below a half, with all their columns; see ``score_toxicity``."""
    # As one column, so that no name of theirs meets one of the features'.
    rows = docs.select(F.struct("*").alias("row"))
    scored = fit(docs, labels).score(rows, "row.text", ["row"])
    return scored.where("__score < 0.5").select("row.*")
