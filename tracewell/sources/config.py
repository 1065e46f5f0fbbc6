"""Profiles and seeds: small text files of keys and records, read on the driver into tables."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Keys of a profile that hold numbers.
NUMBERS = ("max_topics", "max_pages_per_topic", "max_concurrency", "crawl_delay_seconds")
_PAIR = re.compile(r"^\s*(?:- )?\s*([A-Za-z_][\w-]*)\s*:\s*(.*?)\s*$")


def _value(text: str) -> str | None:
    text = text.strip()
    return text[1:-1] if len(text) > 1 and text[0] == text[-1] and text[0] in "\"'" else text or None


def _pairs(lines: Iterable[str]) -> Iterable[tuple[bool, str, str | None]]:
    """(begins a record, key, value) of each line with a key; what stands in a line after ' #' is left out."""
    for line in lines:
        if not line.lstrip().startswith("#") and (found := _PAIR.match(line.split(" #")[0])):
            yield line.lstrip().startswith("- "), found[1], _value(found[2])


def profile(text: str) -> dict[str, str | int | None]:
    """Keys and values of a profile, the first of each key; how deep a key stands doesn't count."""
    out: dict[str, str | int | None] = {}
    for _, key, value in _pairs(text.splitlines()):
        if key not in out:
            out[key] = int(value) if key in NUMBERS and value and value.isdigit() else value
    return out


def seeds(spark: SparkSession, text: str) -> DataFrame:
    """(seed_ord, seed_id, url, label, status, focus, max_pages) of a file of records that begin with '- id:'; those without an address are left out."""
    records: list[dict[str, str | None]] = []
    for begins, key, value in _pairs(text.splitlines()):
        if begins and key == "id":
            records.append({})
        if records:
            records[-1].setdefault(key, value)
    rows = [r for r in records if r.get("url")]
    number = lambda v: max(1, int(v)) if v and v.isdigit() else 1
    return spark.createDataFrame([(i, r.get("id"), r["url"], r.get("label"), r.get("status"), r.get("focus"), number(r.get("max_pages"))) for i, r in enumerate(rows)], "seed_ord int, seed_id string, url string, label string, status string, focus string, max_pages int")
