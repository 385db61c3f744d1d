"""Fill-in-middle transformation: documents cut at two token borders and reordered as prefix, suffix, middle.

A text is a row of units, runs of ASCII letters or single other characters. One ``fullmatch`` of the repeated unit keeps
the end of every repetition, so their number and both cut offsets come from one list without a loop over units. Only
the three numbers leave Python; texts are cut and joined by Spark, whose strings never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
OTHER = regex.compile(r"[^A-Za-z]")

#: Markers of the parts: prefix, suffix, middle.
MARKERS = ("<P>", "<S>", "<M>")

#: Characters matched at a time. A longer text goes through in stretches that end where a unit ends, since each
#: repetition that a match keeps takes some tens of bytes; results don't depend on it.
STRETCH = 1 << 20


def unit_ends(text: str, stretch: int = STRETCH) -> np.ndarray:
    """End of every unit, in code points."""
    found, at = [], 0
    while at < len(text):
        cut = len(text)
        if cut - at > stretch:
            # The character before another one that is no letter always ends a unit.
            border = OTHER.search(text, at + stretch)
            cut = border.start() if border else cut
        ends = UNITS.fullmatch(text, at, cut).ends(1)
        found.append(np.array(ends, np.int64))
        at = cut
    return np.concatenate(found) if found else np.empty(0, np.int64)


@F.pandas_udf(StructType([StructField(c, LongType()) for c in ("n", "first", "second")]))
def _cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, one, two in batches:
        rows = []
        for text, h1, h2 in zip(texts, one, two, strict=True):
            ends = unit_ends(text)
            n = len(ends)
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            rows.append((n, int(ends[a - 1]) if a else 0, int(ends[b - 1]) if b else 0))
        yield pd.DataFrame(rows, columns=["n", "first", "second"], dtype="int64")


def _draw(key: Column, epoch: int, i: int) -> Column:
    """The i-th 8-digit group of the SHA-256 of ``epoch:key``, as a number."""
    digits = F.sha2(F.concat(F.lit(f"{epoch}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", epoch: int = 1, rate: int = 90, spm_rate: int = 20,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """One row per document: key, n (units), form, prefix_chars, middle_chars, output.

    ``rate`` in 100 documents are transformed, ``spm_rate`` in 100 of these put the suffix first; both and the cuts
    follow from ``epoch`` and the key alone, so another epoch draws anew. ``output`` by form: plain, the text; psm,
    prefix marker, prefix, suffix marker, suffix, middle marker, middle; spm, the suffix with its marker first.

    A null text is empty. Empty texts and texts that hold a marker stay plain whatever is drawn, so that ``restored``
    is exact. A null key draws as the empty string; rows of equal keys draw alike, each on its own text, and each
    gives a row. A cut at the start or end, or two equal cuts, give empty parts. Very long texts are matched in
    stretches and cut whole. Other columns of ``docs`` are not read; an empty table gives an empty table.
    """
    p, s, m = (F.lit(x) for x in markers)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("cuts", _cuts("text", _draw(F.col("key"), epoch, 0), _draw(F.col("key"), epoch, 1)))
    marked = F.lit(False)
    for marker in (p, s, m):
        marked = marked | F.contains("text", marker)
    plain = (F.col("text") == "") | marked | (_draw(F.col("key"), epoch, 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_draw(F.col("key"), epoch, 3) % 100 < spm_rate, "spm").otherwise("psm")
    first, second = F.col("cuts.first"), F.col("cuts.second")
    rows = rows.select("key", "text", F.col("cuts.n").alias("n"), form.alias("form"), first.alias("first"), (second - first).alias("between"))
    size = F.char_length("text")
    prefix = F.substring("text", F.lit(1), F.col("first").cast("int"))
    middle = F.substring("text", (F.col("first") + 1).cast("int"), F.col("between").cast("int"))
    suffix = F.substring("text", (F.col("first") + F.col("between") + 1).cast("int"), size)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    moved = F.col("form") != "plain"
    return rows.select(
        F.col("key").alias(key), "n", "form", F.when(moved, F.col("first")).alias("prefix_chars"),
        F.when(moved, F.col("between")).alias("middle_chars"), output.alias("output"),
    )


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone.

    Texts with a marker stay plain, so the first place of each marker is the one that the transformation wrote.
    """
    p, s, m = markers

    def part(opening: str, closing: str | None) -> Column:
        start = F.instr(output, opening) + len(opening)
        if closing is None:
            return F.substring(output, start, F.char_length(output))
        return F.substring(output, start, F.instr(output, closing) - start)

    psm = F.concat(part(p, s), part(m, None), part(s, m))
    spm = F.concat(part(p, m), part(m, None), part(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


#: Twin of the query on the table ``documents``.
SQL = """
    with units as (
        select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as sha,
               regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units
        from documents),
    drawn as (
        select *, len(units) as n, cast('0x' || substr(sha, 1, 8) as bigint) as h1, cast('0x' || substr(sha, 9, 8) as bigint) as h2,
               cast('0x' || substr(sha, 17, 8) as bigint) as h3, cast('0x' || substr(sha, 25, 8) as bigint) as h4
        from units),
    cut as (
        select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
               case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                    when h4 % 100 < 20 then 'spm' else 'psm' end as form
        from drawn),
    parts as (
        select *, coalesce(array_to_string(units[1:a], ''), '') as prefix, coalesce(array_to_string(units[a + 1:b], ''), '') as middle,
               coalesce(array_to_string(units[b + 1:], ''), '') as suffix
        from cut)
    select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
           case when form <> 'plain' then length(middle) end as middle_chars,
           sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
           sha256(text) as restored_sha256
    from parts"""
