"""Keyword index and search: BM25 with boosts for exact terms and phrases, for many queries in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewell.functions import text as T
from tracewell.operators.stages import once, stored

K1, B, EXACT, PHRASE = 1.5, 0.75, 1.75, 2.5


@dataclass(frozen=True)
class Index:
    units: DataFrame  # the indexed rows with their key
    docs: DataFrame  # key, ord, len, tokens
    corpus: DataFrame  # doc_count, avg_len
    saved: DataFrame | None = None  # term, key, tf, where the index was read from a folder

    @property
    def postings(self) -> DataFrame:
        """(term, key, tf)."""
        return self.saved if self.saved is not None else self.docs.select("key", F.explode("tokens").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf")).select("term", "key", "tf")

    @property
    def exact(self) -> DataFrame:
        """(term, key) of terms with a digit or a separator."""
        return self.postings.where(T.is_exact(F.col("term"))).select("term", "key")

    @property
    def terms(self) -> DataFrame:
        """(term, df)."""
        return self.postings.groupBy("term").agg(F.count("*").alias("df"))

    def of(self, asked: DataFrame) -> DataFrame:
        """(term, key, tf, len, ord) of the few terms in asked(term): rows of other terms are dropped before anything is counted."""
        if self.saved is not None:
            return self.saved.join(F.broadcast(asked), "term").join(self.docs.select("key", "len", "ord"), "key").select("term", "key", "tf", "len", "ord")
        found = self.docs.select("key", "len", "ord", F.explode("tokens").alias("term")).join(F.broadcast(asked), "term")
        return found.groupBy("key", "term", "len", "ord").agg(F.count("*").alias("tf")).select("term", "key", "tf", "len", "ord")

    def write(self, path: str) -> None:
        """Four tables; postings are sorted by term, so that readers skip row groups."""
        for name in ("units", "docs", "corpus"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        self.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")

    @staticmethod
    def read(spark: SparkSession, path: str) -> Index:
        return Index(*(spark.read.parquet(f"{path}/{n}") for n in ("units", "docs", "corpus", "postings")))


def tokenised(units: DataFrame, key: str = "post_id") -> DataFrame:
    """(key, ord, len, tokens) of units with title, text and ord, for one reader: nothing is stored."""
    return once(units.withColumn("key", F.col(key)), "tokens", T.tokens(F.trim(F.concat_ws(" ", "title", "text")))).select("key", "ord", F.size("tokens").alias("len"), "tokens")


def build(units: DataFrame, key: str = "post_id") -> Index:
    """Index of units with title, text and ord, by one of their columns. Tokens are found once and stored, without the texts."""
    docs = stored(tokenised(units, key))
    return Index(units.withColumn("key", F.col(key)), docs, docs.agg(F.count("*").alias("doc_count"), F.avg(F.greatest(F.lit(1), "len")).alias("avg_len")))


def analyse(spark: SparkSession, queries: Sequence[tuple[str, str]]) -> DataFrame:
    """(query_id, query, terms, exact_terms, technical_terms, phrases); a few rows."""
    q = spark.createDataFrame(list(queries), "query_id string, query string")
    q = q.select("query_id", "query", T.tokens(F.col("query")).alias("terms"), T.aliases(F.col("query")).alias("technical_terms"))
    return q.select("*", T.exact_terms(F.col("terms")).alias("exact_terms"), T.phrases(F.col("terms")).alias("phrases"))


def _asked(analysed: DataFrame) -> DataFrame:
    return analysed.select(F.explode(F.array_union("terms", "exact_terms")).alias("term")).distinct()


def specific_terms(index: Index, analysed: DataFrame, hits: DataFrame | None = None) -> DataFrame:
    """(query_id, term, structured): rare terms (in at most 8 % of the units, or 3) and exact ones with a separator."""
    q = analysed.select("query_id", F.explode(F.array_distinct("terms")).alias("term")).where(~F.col("term").rlike(r"^\d+$"))
    df = (index.of(_asked(analysed)) if hits is None else hits).groupBy("term").agg(F.count("*").alias("df"))
    found = q.join(df, "term", "left").crossJoin(F.broadcast(index.corpus))
    rare = F.col("df").between(1, F.greatest(F.lit(3), F.floor(F.col("doc_count") * 0.08)))
    structured = T.is_structured(F.col("term"))
    return found.where(F.coalesce(rare, F.lit(False)) | structured).select("query_id", "term", structured.alias("structured"))


def scores(index: Index, analysed: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, key, bm25, exact, phrase, matched terms of each sort, touch): one row for each unit that matches; hits: Index.of the asked terms.

    The query side is some terms and phrases, so it is what is broadcast; units are only aggregated. Phrases match as parts of the text, so they
    are looked for in all units.
    """
    q = F.broadcast(analysed.select("query_id", F.posexplode("terms").alias("pos", "term")))
    idf = F.log(1 + (F.col("doc_count") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    wanted = hits.groupBy("term").agg(F.count("*").alias("df"))
    found = hits.join(F.broadcast(wanted), "term").join(q, "term").crossJoin(F.broadcast(index.corpus))
    share = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.greatest(F.lit(1), "len") / F.col("avg_len")))
    none = F.lit(None).cast("string")
    bm25 = found.select("query_id", "key", "ord", (idf * share).alias("bm25"), F.lit(0.0).alias("exact"), F.lit(0.0).alias("phrase"), F.col("term").alias("t"), none.alias("e"), none.alias("p"), F.struct(F.lit(0).alias("phase"), "pos", "ord").alias("touch"))
    x = F.broadcast(analysed.select("query_id", F.posexplode("exact_terms").alias("pos", "term")))
    found = hits.join(x, "term")
    exact = found.select("query_id", "key", "ord", F.lit(0.0).alias("bm25"), F.lit(EXACT).alias("exact"), F.lit(0.0).alias("phrase"), none.alias("t"), F.col("term").alias("e"), none.alias("p"), F.struct(F.lit(1).alias("phase"), "pos", "ord").alias("touch"))
    p = F.broadcast(analysed.select("query_id", F.posexplode("phrases").alias("pos", "phrase_text")))
    found = index.docs.select("key", "ord", F.array_join("tokens", " ").alias("exact_text")).join(p, F.col("exact_text").contains(F.col("phrase_text")))
    phrase = found.select("query_id", "key", "ord", F.lit(0.0).alias("bm25"), F.lit(0.0).alias("exact"), F.lit(PHRASE).alias("phrase"), none.alias("t"), none.alias("e"), F.col("phrase_text").alias("p"), F.struct(F.lit(2).alias("phase"), "pos", "ord").alias("touch"))
    matched = bm25.unionByName(exact).unionByName(phrase).groupBy("query_id", "key")
    sets = [F.array_sort(F.collect_set(c)).alias(n) for c, n in (("t", "matched_terms"), ("e", "matched_exact_terms"), ("p", "matched_phrases"))]
    return matched.agg(*[F.sum(c).alias(c) for c in ("bm25", "exact", "phrase")], *sets, F.min("touch").alias("touch"))


def search(index: Index, analysed: DataFrame, k: int = 5) -> DataFrame:
    """The k best units of each query with their scores, rank and a snippet."""
    hits = stored(index.of(_asked(analysed)))
    specific = specific_terms(index, analysed, hits).groupBy("query_id").agg(F.collect_set("term").alias("specific"), F.collect_set(F.when(F.col("structured"), F.col("term"))).alias("structured"))
    empty = F.array().cast("array<string>")
    found = scores(index, analysed, hits).join(F.broadcast(specific), "query_id", "left").withColumns({c: F.coalesce(c, empty) for c in ("specific", "structured")})
    found = found.withColumn("total", F.round(F.col("bm25") + F.col("exact") + F.col("phrase"), 9))
    found = found.withColumn("matched_specific_terms", F.array_sort(F.array_intersect(F.array_union("matched_terms", "matched_exact_terms"), "specific")))
    keys = [F.size(F.array_intersect("matched_exact_terms", "structured")), F.col("total"), F.size("matched_specific_terms"), F.size("matched_exact_terms"), F.size("matched_phrases")]
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*[c.desc() for c in keys], F.col("touch").asc())))
    top = ranked.where(F.col("rank") <= k).drop("specific", "structured", "touch", "ord")
    out = index.units.join(F.broadcast(stored(top)), "key")
    needles = F.concat("matched_exact_terms", "matched_terms")
    return out.withColumn("snippet", T.snippet(F.col("text"), needles)).withColumn("score", F.round("total", 6)).withColumns({c: F.round(c, 6) for c in ("bm25", "exact", "phrase")}).drop("total")


def packet_id(query):
    return F.concat(F.lit("query-"), F.substring(F.sha2(F.trim(query), 256), 1, 16))
