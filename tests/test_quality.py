from __future__ import annotations

import pytest

from perilspark.operators.quality import RAIN_SCORES, TEMPERATURE_SCORES, clean_rain, clean_temperature, mask_sentinels

TN_FLAGS = ["TNUP", "DTLO", "TNLO", "TNXL", "TNJU", "UPTN", "LOTN"]
PR_FLAGS = ["PCUP", "SUCU2", "PCGA"]


def cleaned(spark, clean, value, scores, flags, marks, base):
    row = {n: base.get(n, 0.0) for n in scores if n != value} | {n: 0 for n in flags} | {value: 5.0} | marks
    schema = ", ".join(f"{n} {'int' if n in flags else 'double'}" for n in row)
    return clean(spark.createDataFrame([tuple(row.values())], schema)).first()


@pytest.mark.parametrize("marks,bad", [
    ({}, False), ({"TNUP": 1}, False), ({"DTLO": 1}, False), ({"TNUP": 1, "DTLO": 1}, True), ({"TNLO": 1, "DTLO": 1}, True),
    ({"TNXL": 1}, True), ({"TNJU": 1}, True), ({"UPTN": 1}, True), ({"LOTN": 1}, False), ({"LOTN": 1, "TNLO": 1}, True),
    ({"othQualProb": 2.0}, False), ({"othQualProb": 2.0, "misTempInt": 2.0}, True), ({"othQualProb": 3.0, "grossInhoFreq": 3.0}, True),
    ({"othQualProb": 2.0, "grossInhoFreq": 3.0}, False), ({"monOutlierAcmAll": 1.0, "monOutlierAcmSel": 1.0}, True),
    ({"monOutlierAcmAll": 1.0, "monOutlierAcmSel": -99.9}, False),
])
def test_temperature_rules(spark, marks, bad):
    row = cleaned(spark, clean_temperature, "TN", TEMPERATURE_SCORES, TN_FLAGS, marks, {})
    assert (row["TN_clean"] is None) == bad and max(row["flagNA"], row["flagNA_2"]) == int(bad)


@pytest.mark.parametrize("marks,bad", [
    ({}, False), ({"PCUP": 1, "SUCU2": 1}, False), ({"PCUP": 1, "SUCU2": 1, "PCGA": 1}, True), ({"prcpTru": 2.0}, True),
    ({"prcpTruAccum": 10.0}, True), ({"prcpTruAccum": -99.0}, False), ({"prcpGapLimit": 4.0}, True), ({"prcpGapLimit": 3.9}, False),
    ({"meaPrec": 4.0, "othQualProb": 3.0, "meaPrecInc": 3.0}, False),
    ({"meaPrec": 4.0, "othQualProb": 3.0, "meaPrecInc": 3.0, "meaPrecInd": 3.0}, True),
])
def test_rain_rules(spark, marks, bad):
    row = cleaned(spark, clean_rain, "PRCP", RAIN_SCORES, PR_FLAGS, marks, {"prcpTruAccum": 11.0})
    assert (row["PRCP_clean"] is None) == bad


def test_sentinels(spark):
    df = spark.createDataFrame([(v,) for v in (-99.0, -99.9, -98.9, None)], "v double")
    assert [r[0] for r in mask_sentinels(df, ["v"]).collect()] == [None, None, -98.9, None]


def test_rain_sentinel_is_missing(spark):
    row = cleaned(spark, clean_rain, "PRCP", RAIN_SCORES, PR_FLAGS, {"PRCP": -99.9}, {"prcpTruAccum": 11.0})
    assert row["PRCP_clean"] is None and row["flagNA"] == 0
