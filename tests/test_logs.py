"""D13-D15 edge lines (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from gapledger.operators import logs


def test_exception_slices(spark):
    lines = spark.createDataFrame([
        ("t exception Boom records: 7 id: 1",),
        ("t exception Boom retry records: 7 id: 2",),      # retry inside the slice: dropped
        ("t exception Boom records: 7 retry id: 3",),      # retry after the cut: kept
        ("t exception Tail without end",),                  # no end marker: to end of line
        ("no marker at all",),                              # not an exception (B11)
        (None,),
    ], "value string")
    got = sorted(r.exception for r in logs.extract_exceptions(lines).collect())
    assert got == ["exception Boom ", "exception Boom ", "exception Tail without end"]
    c = logs.exception_counts(lines).first()
    assert (c.total_exceptions, c.unique_exceptions) == (3, 2)


def test_failed_events(spark):
    ok = ('x Failed sending Contract event to SF with {"event_name"=>"Contract Signed And Countersigned", '
          '"company_uuid"=>"c1", "membership_agreement_uuid"=>"m1"} exception Timeout')
    no_contract = 'y {"event_name"=>"Sent", "company_uuid"=>"c2"} exception E2'
    lines = spark.createDataFrame([
        (ok,), (no_contract,),
        ('z {"event_name"=>"Sent", "company_uuid"=>"c3"} exception E3 retry',),   # retry anywhere: dropped
        ('w {"other"=>"1"} exception E4',),                                        # no event in payload
        ('v {"event_name"=>"Sent"} exception E5',),                                # no company: null (B12)
    ], "value string")
    got = sorted((r.event, r.exception, r.company, r.contract) for r in logs.extract_failed_events(lines).collect())
    assert got == [("Contract Signed And Countersigned", "Timeout", "c1", "m1"),
                   ("Sent", "E2", "c2", None), ("Sent", "E5", None, None)]


def test_error_rate(spark):
    fails = spark.createDataFrame([("m1",), ("m1",), ("m2",), (None,)], "contract string")
    import datetime as dt
    ags = spark.createDataFrame([(i, dt.datetime(2018, 3, 1 + i)) for i in range(8)], "id long, created timestamp_ntz")
    r = logs.error_rate(fails, ags, "created", "id", "2018-03-01", "2018-03-06").first()
    # open range: 2018-03-02 .. 2018-03-05 -> 4 agreements
    assert (r.failing_contracts, r.agreements_created, r.error_rate_pct) == (2, 4, 50.0)
    z = logs.error_rate(fails, ags.where(F.lit(False)), "created", "id").first()
    assert z.error_rate_pct is None


def test_error_rate_counts_text_ids(spark):
    fails = spark.createDataFrame([("m1",)], "contract string")
    ags = spark.sql("SELECT * FROM VALUES ('u-1', TIMESTAMP_NTZ'2018-03-02'), (NULL, TIMESTAMP_NTZ'2018-03-02'), "
                    "('u-2', TIMESTAMP_NTZ'2018-03-02') AS t(uuid, created)")
    r = logs.error_rate(fails, ags, "created", "uuid").first()
    assert (r.failing_contracts, r.agreements_created, r.error_rate_pct) == (1, 2, 50.0)


def test_failed_event_keys(spark):
    e = spark.createDataFrame([("c1", "k1"), ("c1", None), (None, "k1"), (None, None), ("c2", "k2")], "company string, contract string")
    assert tuple(logs.failed_event_keys(e).first()) == (5, 2, 2)
    assert tuple(logs.failed_event_keys(e.limit(0)).first()) == (0, 0, 0)
