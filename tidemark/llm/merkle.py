"""Document fingerprints (operator 4): a Merkle tree over paragraphs and sections, in DataFrame functions only.

A paragraph is a line with its line feed; its leaves are pieces of up to four words that start anew after a full
stop. A section starts at a heading line and at about one paragraph in eight, chosen by the paragraph's digest, so an
insertion moves no later border. Paragraph digests hash the paragraph's bytes, section digests their paragraphs', the root
its sections'. Equal roots mean equal texts; differing branches locate edits; shared leaves measure likeness.

Null texts count as empty; an empty text has the root of no sections. Repeated rows have equal fingerprints. An
empty table gives an empty table. Only the columns named are read, so others may have any name. Texts are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import removed, written

#: Up to three words that end no sentence, and one word of any kind, each with the white space after it.
PIECE = r"\s*(?:\S*[^\s.!?]\s+){0,3}\S+\s*|\s+"
#: First hexadecimal digits of the digests that start a section.
STARTS = "[01]"
_LOWEST = -(1 << 63)
#: Chunks of neighbouring rows, at most; their borders go to the driver and to every task.
CHUNKS = 16_384


def paragraphs(text: Column) -> Column:
    """The lines of ``text``, each with its line feed; joined they are the text again."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=\n)"), lambda p: p != "")


def leaves(lines: Column) -> Column:
    """Hashes of the pieces of every paragraph."""
    return F.transform(lines, lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda x: F.xxhash64(x)))


def _entries(lines: Column, hashes: Column) -> Column:
    """For each paragraph: s (starts a section) or p, its digest, a point, its leaves in hexadecimal."""

    def entry(line: Column, own: Column) -> Column:
        digest = F.substring(F.sha2(line.cast("binary"), 256), 1, 32)
        start = F.when(line.rlike(r"^#{1,6}\s") | digest.rlike("^" + STARTS), F.lit("s")).otherwise(F.lit("p"))
        short = F.transform(own, lambda h: F.lpad(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
        return F.concat(start, digest, F.lit("."), F.lower(F.array_join(short, "")))

    return F.zip_with(lines, hashes, entry)


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds ``{prefix}leaves`` (hashes), ``{prefix}sections`` (digest:paragraphs) and ``{prefix}root``."""
    a, b, c, d = (f"{prefix}{x}" for x in ("_lines", "_hashes", "sections", "leaves"))
    df = df.withColumn(a, paragraphs(F.col(text))).withColumn(b, leaves(F.col(a)))
    df = df.withColumn(c, F.filter(F.split(F.array_join(_entries(F.col(a), F.col(b)), ","), ",(?=s)"), lambda s: s != ""))
    df = df.withColumn(c, F.transform(c, lambda s: F.concat(F.substring(F.sha2(s.cast("binary"), 256), 1, 32), F.lit(":"), s)))
    df = df.withColumn(d, F.array_distinct(F.flatten(b))).drop(a, b)
    root = F.sha2(F.array_join(F.transform(c, lambda s: F.substring(s, 1, 32)), "").cast("binary"), 256)
    return df.withColumn(f"{prefix}root", root)


def fingerprint(root: Column, sections: Column) -> Column:
    """The tree as one string: root;section/section with section = digest:paragraph,paragraph."""
    return F.concat(root, F.lit(";"), F.array_join(sections, "/"))


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared leaves over all leaves of both (arrays of distinct hashes); 1 for two empty texts."""
    sizes = F.size(a) + F.size(b)
    return F.when(sizes == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / sizes)


def differing_sections(a: Column, b: Column) -> Column:
    """The sections of ``a`` that ``b`` doesn't have: the branches in which an edit lies."""
    return F.array_except(a, b)


def chunk_of(place: Column, cuts: list[tuple[int, int]]) -> Column:
    """How many of the ascending ``cuts`` are at or below ``place`` (a struct of key and tie), by binary search in a constant array."""
    size = 1
    while size <= len(cuts):
        size *= 2
    padded = [*cuts, *[((1 << 63) - 1, (1 << 63) - 1)] * (size - len(cuts))]
    keys, ties = (F.split(F.lit(",".join(str(c[i]) for c in padded)), ",").cast("array<bigint>") for i in (0, 1))
    array = F.arrays_zip(keys, ties).cast("array<struct<key:bigint,tie:bigint>>")
    steps = F.array(*[F.lit(size >> k) for k in range(1, size.bit_length())]) if size > 1 else F.array().cast("array<int>")
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.element_at(array, at + step) <= place), at + step).otherwise(at),
    )


def in_chunks(docs: DataFrame, rows_per_chunk: int = 20_000) -> DataFrame:
    """``docs`` in chunks of neighbouring places: adds ``_place`` (id, null ids lowest, then the text's hash), ``_chunk`` and ``_guest``.

    Spark's range partitioning of the places alone, which are written once, gives the borders, at most ``CHUNKS``. Each chunk also
    holds, as a guest, a copy of the row that follows its last one in descending order (after the last row: the first), so a window
    over the chunk sees every neighbour and no task holds more than its chunk. Rows of one id lie in as many chunks as they fill.
    """
    spark = docs.sparkSession
    place = F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)).alias("key"), F.xxhash64("text").alias("tie"))
    narrow = written(docs.select(place.alias("_place")), "places")
    parts = min(CHUNKS, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), narrow.count() // rows_per_chunk))
    borders = (
        narrow.repartitionByRange(parts, "_place").groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("_place").alias("low"), F.max("_place").alias("high")).orderBy("low").collect()
    )  # two places for each chunk, of which there are CHUNKS at most
    removed(narrow)
    follow = spark.createDataFrame(
        [(*borders[i - 1].high, i) for i in range(len(borders))], "key bigint, tie bigint, _chunk int"
    ).select(F.struct("key", "tie").alias("_place"), "_chunk")  # as many rows as chunks; the lowest chunk is followed by the highest place
    keyed = docs.withColumn("_place", place)
    own = keyed.withColumn("_chunk", chunk_of(F.col("_place"), [tuple(b.low) for b in borders[1:]])).withColumn("_guest", F.lit(False))
    # repeated rows are one guest
    guests = keyed.join(F.broadcast(follow), "_place").dropDuplicates(["_place", "_chunk"]).withColumn("_guest", F.lit(True))
    return own.unionByName(guests)


def compared(documents: DataFrame) -> DataFrame:
    """For every document its fingerprint, that of its edited text, and their likeness (see the query's contract)."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = with_tree(in_chunks(docs).repartition("_chunk"), "text", "")
    w = Window.partitionBy("_chunk").orderBy("_guest", F.desc("_place"))
    both = both.withColumns({"_next": F.lead("text").over(w), "_next_leaves": F.lead("leaves").over(w)}).filter(~F.col("_guest"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    both = both.withColumn(
        "_edited", F.concat(F.col("text").substr(F.lit(1), n - half), F.col("_next").substr(F.lit(1), half))
    )
    both = with_tree(both, "_edited", "edited_")
    return both.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("root"), F.col("sections")).alias("fingerprint"),
        fingerprint(F.col("edited_root"), F.col("edited_sections")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("_next_leaves")).alias("near_next"),
        F.size(differing_sections(F.col("edited_sections"), F.col("sections"))).alias("n_edited_sections"),
    )
