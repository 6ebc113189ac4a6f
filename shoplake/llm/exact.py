"""Exact duplicates: sorted runs of digests, merged in a tree.

Every text becomes a SHA-256 digest with its length in bytes. Input partitions are the first
runs. In each round of a binomial exchange the runs whose numbers differ in one digit (base
``radix``) swap entries: an entry moves to the run whose digit its digest names. The runs that
meet are sorted and merged, and of equal digests one entry stays, with the largest identifier
and the number of rows. After the last round a run holds all that is left of its digests. An
entry is some 60 bytes whatever the text's length, and a group of copies is one entry per run
from the first round on, however many rows it has.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import lower_ascii, stored, tasks


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``sha`` (binary) and ``size`` of each normalised text; null counts as empty."""
    text = lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("t"))
    return rows.select("id", F.unhex(F.sha2("t", 256)).alias("sha"), F.octet_length("t").alias("size"))


def merge_runs(entries: DataFrame, runs: int, radix: int = 4) -> DataFrame:
    """One row per digest: ``keep`` (largest id) and ``copies``. ``runs``: how many runs at least."""
    places = [1]
    while radix * places[-1] < runs:
        places.append(radix * places[-1])
    total = radix * places[-1]
    target = F.pmod(F.xxhash64("sha"), F.lit(total)).cast("int")

    def digit(number, place):
        return F.floor(number / place).cast("int") % radix * place

    merged = entries.select(
        (F.spark_partition_id() % total).alias("run"),
        "sha",
        "size",
        F.struct("id").alias("keep"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    for done, place in enumerate(reversed(places)):
        run = F.col("run") - digit(F.col("run"), place) + digit(target, place)
        moved = merged.withColumn("run", run)
        # The first round combines each task's copies before anything moves. The largest of
        # structs is found by sorting, so every run comes out sorted by digest.
        if done:
            moved = moved.repartitionById(total, "run")
        merged = moved.groupBy("run", "sha", "size").agg(
            F.max("keep").alias("keep"), F.sum("copies").alias("copies")
        )
    return merged.select("sha", "size", F.col("keep.id").alias("keep"), "copies")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radix: int = 4
) -> DataFrame:
    """Each row's group of equal texts, and whether it is the row that stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` for every input row. Texts are
    equal when identical after lower-casing A-Z; of a group the largest id stays. Null texts
    count as empty. A null id gives way to any other; in a group without ids all rows are
    kept. Rows that repeat both id and text all count, and are kept or dropped together.
    Other columns play no part, whatever their names. No rows in, no rows out.
    """
    read = stored(digests(docs, id_col, text_col))
    merged = merge_runs(read, tasks(docs.sparkSession), radix)
    copied = merged.where("copies > 1").withColumnsRenamed({"sha": "sha_", "size": "size_"})
    same = (F.col("sha") == F.col("sha_")) & (F.col("size") == F.col("size_"))
    keep = F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("keep"))
    return read.join(copied, same, "left").select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat id and text the
    smallest, column by column from the left, nulls first.

    Rows without an id all stay where no other row has their text, as ``exact_groups`` says.
    What goes is settled on ids and digests; a text moves once at most, and not at all if what
    goes is small enough for Spark to send it to the texts.
    """
    text = lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    doc_id = F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("-"))
    groups = exact_groups(docs, id_col, text_col)
    own = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_sha256")
    # One row for an id and a text that goes, or that is there more than once.
    counted = groups.groupBy(own.alias("of")).agg(F.first("kept").alias("kept"), F.count("doc_id").alias("rows"))
    counted = stored(counted.where("not kept or rows > 1"))
    # As one column, so that no name of theirs meets one of these.
    keyed = docs.select(F.struct("*").alias("row"), F.concat_ws(":", doc_id, F.sha2(text, 256)).alias("key"))
    left = keyed.join(counted.select("of"), F.col("key") == F.col("of"), "left_anti")
    repeated = keyed.join(counted.where("kept").select("of"), F.col("key") == F.col("of"), "left_semi")
    first = repeated.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("row")))
    return left.unionByName(first.where("place = 1").drop("place")).select("row.*")


SQL = """
select doc_id, max(doc_id) over (partition by t) as keep_id,
    count(*) over (partition by t) as group_size,
    doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as t from documents)
"""
