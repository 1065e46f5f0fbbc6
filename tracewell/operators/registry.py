"""The registry of sources: checks, upserts, and the plan of a crawl. A registry is a table with a row for each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.policy import source_id

# Fixed values.
KINDS = ["topic", "forum", "search", "profile"]
ACCESS = ["public", "operator_authenticated"]
MEDIA = ["none", "images", "files", "all"]


def tags(c: Column) -> Column:
    """Lower-case tags with dashes for white space, each once, in their order."""
    one = F.transform(c, lambda t: F.regexp_replace(F.lower(F.trim(t)), r"(?U)\s+", "-"))
    return F.array_distinct(F.filter(one, lambda t: t != ""))


def from_csv(c: Column) -> Column:
    """The parts of a list with commas, without blanks around them or empty ones."""
    return F.filter(F.transform(F.split(c, ","), lambda t: F.trim(t)), lambda t: t != "")


def errors(given: DataFrame) -> DataFrame:
    """(source_ref, kind, error): what is wrong with given sources; no rows if all may be taken."""
    wrong = lambda c, names: F.coalesce(~c.isin(names), F.lit(True))
    checks = [
        (F.coalesce(F.trim("source_ref") == "", F.lit(True)), "empty_source_ref"),
        (wrong(F.col("kind"), KINDS), "unsupported_kind"),
        (wrong(F.coalesce("access", F.lit("public")), ACCESS), "unsupported_access"),
        (wrong(F.coalesce("include_media", F.lit("none")), MEDIA), "unsupported_media_policy"),
        (F.coalesce(~F.col("trust_score").between(0.0, 1.0), F.lit(False)), "trust_score_out_of_range"),
    ]
    return given.select("source_ref", "kind", F.explode(F.array_compact(F.array(*[F.when(c, name) for c, name in checks]))).alias("error"))


def upsert(registry: DataFrame, given: DataFrame, now: Column) -> DataFrame:
    """The registry with the given sources: (source_id, source_ref, kind, access, title, scope, tags, trust_score, enabled, include_media, created_at, updated_at, change).

    A source is known by its kind and reference. What isn't given is kept from the entry that was there; its time of creation always is. Of
    several given rows for one source the last by ord counts. change is created, updated or kept.
    """
    new = given.withColumn("source_id", source_id(F.trim("kind"), F.trim("source_ref"))).groupBy("source_id").agg(F.max_by(F.struct(*[c for c in given.columns if c != "ord"]), "ord").alias("n"))
    both = registry.withColumn("o", F.struct(*[c for c in registry.columns if c != "source_id"])).select("source_id", "o").join(new, "source_id", "full")
    is_new, was = F.col("n").isNotNull(), lambda c: F.col(f"o.{c}")
    ref, kind = F.trim("n.source_ref"), F.trim("n.kind")
    own_tags = tags(F.col("n.tags"))
    fields = {
        "source_ref": F.coalesce(ref, was("source_ref")),
        "kind": F.coalesce(kind, was("kind")),
        "access": F.when(is_new, F.coalesce("n.access", F.lit("public"))).otherwise(was("access")),
        "title": F.coalesce(F.nullif("n.title", F.lit("")), was("title"), ref),
        "scope": F.coalesce(F.nullif("n.scope", F.lit("")), was("scope"), F.concat(F.lit("operator_selected_"), kind)),
        "tags": F.when(F.size(own_tags) > 0, own_tags).otherwise(F.coalesce(was("tags"), F.array().cast("array<string>"))),
        "trust_score": F.coalesce("n.trust_score", was("trust_score")),
        "enabled": F.when(is_new, F.coalesce("n.enabled", F.lit(True))).otherwise(was("enabled")),
        "include_media": F.when(is_new, F.coalesce("n.include_media", F.lit("none"))).otherwise(was("include_media")),
        "created_at": F.coalesce(was("created_at"), now),
        "updated_at": F.when(is_new, now).otherwise(was("updated_at")),
        "change": F.when(is_new & F.col("o").isNotNull(), "updated").when(is_new, "created").otherwise("kept"),
    }
    return both.select("source_id", *[c.alias(n) for n, c in fields.items()])


def crawl_steps(selected: DataFrame, max_pages: int, include_media: str | None = None) -> DataFrame:
    """A step of a crawl for each selected source; nothing is fetched by it."""
    media = F.lit(include_media) if include_media else F.coalesce("include_media", F.lit("none"))
    return selected.select("source_id", "source_ref", "kind", "access", "scope", "tags", "trust_score", F.lit(max_pages).alias("max_pages"), media.alias("include_media"), F.lit("crawl").alias("operation"))
