"""Line dedup by a tree of log templates.

Each line is parsed as a log message. Words with a digit are variable fields. The tree has a fixed depth: the number of words, then the
first LEAD words; a leaf holds templates. A line's templates are its masked words, and, for lines of WIDE words or more, the same
with one of PARTS stretches after the leading words generalised to a variable field. Lines that differ in their numbers or in one
stretch of words meet in one of these.

A template recurs if it comes up in RECURS documents of different text, counted exactly by the hash of the whole text. Copies of a document
are one, so they don't make their lines recur; near copies are documents of their own. Recurring lines are dropped wherever they are, but for
one case: the first document of a template (by id) keeps its line if recurring lines make up half of its words or more, so a passage that
many near copies share stays once.

How it is spread: leaves with fewer than RECURS lines, or lines of one text only, can't hold a recurring template and are dropped by a count, a
minimum and a maximum. Of the others, each template's texts are made distinct by (template, text), and then counted; both sums begin before the
shuffle. Where lines are joined with a leaf or a template that holds more than 1/500 of them, the lines stay where they are. Only the
places of lines are joined back to the texts.

Defined results: a null text stays null and counts as no lines; a text without a dropped line stays as it is, byte for byte. Lines of fewer
than SHORT words are never dropped. A null id counts as the largest one. Repeated rows get the same text, so do the other rows with the
first document's id. No rows give no rows; further columns are kept, and columns named n_lines or n_dropped are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tracewell.llm.spark_util import cut, join_by_count, trim, unused

LEAD, SHORT, WIDE, PARTS, RECURS = 3, 5, 10, 4, 3
_DIGITS = b"0123456789"
_LARGEST = (1 << 63) - 1


def _hash(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def parse(line: str) -> tuple[int, list[int]] | None:
    """Leaf and templates of a line, as hashes; None for one that is too short to drop."""
    words = line.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if n < SHORT:
        return None
    if any(c in line for c in "0123456789"):
        words = [b"\x00" if w.translate(None, _DIGITS) != w else w for w in words]
    lead = b"%d " % n + b" ".join(words[:LEAD])
    rest = words[LEAD:]
    keys = [_hash(lead + b"\n" + b" ".join(rest))]
    if n >= WIDE:
        for p in range(PARTS):
            a, b = p * len(rest) // PARTS, (p + 1) * len(rest) // PARTS
            keys.append(_hash(lead + b"\n%d " % p + b" ".join(rest[:a]) + b"\x01" + b" ".join(rest[b:])))
    return _hash(lead), keys


def parsed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, line, words, doc_words, leaf, keys) of each line that may be dropped."""
    names = ["doc_id", "content", "line", "words", "doc_words", "leaf", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 1024):
                part = b.slice(start, 1024)
                columns: list[list] = [[] for _ in names]
                for doc, text, content in zip(*(c.to_pylist() for c in part.columns)):
                    found, total = [], 0
                    for i, line in enumerate((text or "").split("\n")):
                        n = len(line.split())
                        total += n
                        if n and (got := parse(line)):
                            found.append((i, n, *got))
                    for i, n, leaf, keys in found:
                        for c, v in zip(columns, (doc, content, i, n, total, leaf, keys)):
                            c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        trim()

    given = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LARGEST)).alias("doc_id"), "text", F.xxhash64("text").alias("content"))
    return given.mapInArrow(run, "doc_id long, content long, line int, words int, doc_words int, leaf long, keys array<long>")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, lines): the numbers of the lines to drop, from 0."""
    lines = cut(parsed_lines(docs))
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n"), F.min("content").alias("a"), F.max("content").alias("b")).where(f"n >= {RECURS} AND a <> b").select("leaf", "n")
    open_ = join_by_count(lines, cut(leaves), "leaf", "n").drop("n", "leaf")
    keyed = cut(open_.select("doc_id", "content", "line", "words", "doc_words", F.explode("keys").alias("key")))
    by_text = keyed.groupBy("key", "content").agg(F.min("doc_id").alias("first"))
    recurring = cut(by_text.groupBy("key").agg(F.count("*").alias("n"), F.min("first").alias("first")).where(f"n >= {RECURS}"))
    hits = join_by_count(keyed, recurring, "key", "n").groupBy("doc_id", "content", "line").agg(F.first("words").alias("words"), F.first("doc_words").alias("doc_words"), F.max(F.col("first") == F.col("doc_id")).alias("is_first"))
    by_doc = hits.groupBy("doc_id", "content").agg(F.sum("words").alias("recurring"), F.first("doc_words").alias("doc_words"), F.collect_set(F.struct("line", "is_first")).alias("found"))
    kept_first = F.col("recurring") * 2 >= F.col("doc_words")
    return by_doc.select("doc_id", "content", F.transform(F.filter("found", lambda x: ~(kept_first & x["is_first"])), lambda x: x["line"]).alias("lines")).where("size(lines) > 0")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of docs, the text without the dropped lines, and n_lines and n_dropped."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    row, content, lines = (unused(n, docs.columns) for n in ("_id", "_content", "_lines"))
    given = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.col("doc_id").cast("long"), F.lit(_LARGEST)).alias(row), F.xxhash64("text").alias(content))
    drops = dropped_lines(docs).toDF(row, content, lines)
    joined = given.join(drops, [row, content], "left").select(*[F.col(f"`{c}`") for c in own], lines)
    at = own.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, total, gone = [], [], []
            for text, drop in zip(b.column(at), b.column(len(own))):
                lines = drop.as_py()
                whole = text.as_py()
                if whole is None:
                    texts.append(None)
                    total.append(0)
                    gone.append(0)
                    continue
                total.append(whole.count("\n") + 1)
                gone.append(len(lines or ()))
                if lines:
                    out = set(lines)
                    whole = "\n".join([x for i, x in enumerate(whole.split("\n")) if i not in out])
                texts.append(whole)
            columns = [*b.columns[:at], pa.array(texts, pa.string()), *b.columns[at + 1 : len(own)], pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, "n_lines", "n_dropped"])

    schema = StructType([docs.schema[c] if c != "text" else StructField("text", StringType()) for c in own] + [StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return joined.mapInArrow(run, schema)
