"""Alert rows, routing, history."""

import datetime

from qalathe import schemas as S
from qalathe.plans import alerts as A

AT = datetime.datetime(2024, 5, 1)


def checks(spark, *rows):
    return spark.createDataFrame(
        [(i, name, None, status, {"fail": "error"}.get(status, "info"), None, None, "") for i, (name, status) in enumerate(rows)], S.CHECKS)


def verdicts(spark, *rows):
    return spark.createDataFrame([("tags", f"v{i:02}", f"tag_v{i:02}", s != "none", s) for i, s in enumerate(rows)],
                                 "dimension string, value string, slice string, is_biased boolean, severity string")


def test_validation_alert(spark):
    failing = checks(spark, *[(f"c{i}", "fail") for i in range(7)], ("ok", "pass"))
    row = A.validation_alert(failing, AT).head()
    assert row.severity == "error" and row.message == "Data validation failed with 7 check(s)."
    assert row.details == {"failed_checks": "c0, c1, c2, c3, c4", "total_failures": "7"}
    assert A.validation_alert(checks(spark, ("ok", "pass"), ("w", "warn")), AT).count() == 0


def test_anomaly_alert(spark):
    rows = spark.createDataFrame([("outlier",)] * 3, "type string")
    row = A.anomaly_alert(rows, AT).head()
    assert row.message == "Found 3 anomalies in the data." and row.details["types"] == "outlier"
    assert A.anomaly_alert(rows.limit(0), AT).count() == 0


def test_bias_alert(spark):
    row = A.bias_alert(verdicts(spark, "none", "low", "medium", "low", "low", "low", "low"), AT).head()
    assert row.severity == "warning" and row.details["biased_slices"] == "tag_v01, tag_v02, tag_v03, tag_v04, tag_v05"
    assert A.bias_alert(verdicts(spark, "high", "low"), AT).head().severity == "error"
    assert A.bias_alert(verdicts(spark, "none"), AT).count() == 0


def alert_rows(spark, *severities):
    return spark.createDataFrame([(AT + datetime.timedelta(seconds=i), "t", s, str(i), "m", {}) for i, s in enumerate(severities)], S.ALERTS)


def test_routing(spark):
    rows = alert_rows(spark, "info", "warning", "error", "critical")
    got = {}
    for r in A.route(rows).collect():
        got.setdefault(r.severity, set()).add(r.channel)
    assert got == {"info": {"log"}, "warning": {"log", "slack"}, "error": {"log", "slack", "email"},
                   "critical": {"log", "slack", "email"}}
    assert {r.channel for r in A.route(rows, ("email",)).collect()} == {"email"}


def test_history_keeps_the_last(spark):
    old = alert_rows(spark, *["info"] * 1200)
    new = alert_rows(spark, "error")
    kept = A.append_history(old, new).collect()
    assert len(kept) == 1000 and sum(r.severity == "error" for r in kept) == 1
    assert min(int(r.title) for r in kept if r.severity == "info") == 201
