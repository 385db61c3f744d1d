"""Station quality control: sentinels and flag rules, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flags import flag

# Quality scores whose codes at or below -99 mean "missing".
TEMPERATURE_SCORES = [
    "misTempInt", "asyRoundPat", "meaPrec", "meaPrecInd", "meaPrecInc",
    "othQualProb", "grossInhoFreq", "monOutlierAcmAll", "monOutlierAcmSel",
]
RAIN_SCORES = [
    "PRCP", "prcpTru", "prcpTruAccum", "prcpGap", "prcpGapLimit", "weekCyc", "weekCycStr", "asyRoundPat",
    "meaPrec", "meaPrecInd", "meaPrecInc", "othQualProb", "monOutlierAcmAll", "monOutlierAcmSel",
]


def mask_sentinels(df: DataFrame, columns: list[str], limit: float = -99) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) > limit, F.col(c)) for c in columns})


def _any(*rules: Column) -> Column:
    met = F.lit(False)
    for rule in rules:
        met = met | F.coalesce(rule, F.lit(False))
    return met


def _marked(*names: str) -> Column:
    met = F.lit(True)
    for name in names:
        met = met & (F.col(name) == 1)
    return met


def _at_least(**scores: float) -> Column:
    met = F.lit(True)
    for name, limit in scores.items():
        met = met & (F.col(name) >= limit)
    return met


def _cleaned(df: DataFrame, value: str, by_flags: Column, by_scores: Column) -> DataFrame:
    flagged = df.withColumns({"flagNA": flag(by_flags), "flagNA_2": flag(by_scores)})
    good = (F.col("flagNA") == 0) & (F.col("flagNA_2") == 0)
    return flagged.withColumn(f"{value}_clean", F.when(good, F.col(value)))


def clean_temperature(df: DataFrame) -> DataFrame:
    """Null out suspicious minimum temperatures into ``TN_clean``."""
    # Flag combinations and score limits of the rule book.
    by_flags = _any(
        _marked("TNUP", "DTLO"), _marked("TNLO", "DTLO"), _marked("TNXL"),
        _marked("TNJU"), _marked("UPTN"), _marked("LOTN", "TNLO"),
    )
    by_scores = _any(
        _at_least(othQualProb=2, misTempInt=2),
        _at_least(othQualProb=3, grossInhoFreq=3),
        _at_least(monOutlierAcmAll=1, monOutlierAcmSel=1),
    )
    return _cleaned(mask_sentinels(df, TEMPERATURE_SCORES), "TN", by_flags, by_scores)


def clean_rain(df: DataFrame) -> DataFrame:
    """Null out suspicious daily rain into ``PRCP_clean``."""
    # Flag combinations and score limits of the rule book.
    by_flags = _any(_marked("PCUP", "SUCU2", "PCGA"))
    by_scores = _any(
        _at_least(prcpTru=2),
        F.col("prcpTruAccum") <= 10,
        _at_least(prcpGapLimit=4),
        _at_least(meaPrec=4, othQualProb=3, meaPrecInc=3, meaPrecInd=3),
        _at_least(monOutlierAcmAll=1, monOutlierAcmSel=1),
    )
    return _cleaned(mask_sentinels(df, RAIN_SCORES), "PRCP", by_flags, by_scores)
