"""Ad-hoc statements on tables shaped like the source warehouse."""

import datetime as dt

from gapledger.plans import warehouse_reports as wr

D = dt.datetime


def test_funnel_and_counts(spark):
    lead = spark.createDataFrame([(1, D(2018, 1, 5)), (2, D(2018, 2, 5)), (3, D(2018, 2, 6))], "id long, created_date timestamp_ntz")
    opp = spark.createDataFrame([
        ("o1", "a1", D(2018, 1, 7), D(2018, 1, 20), "Closed Won", "rt1", "Hot Desk", 3, None),
        ("o2", "a2", D(2018, 2, 7), D(2018, 2, 20), "Closed Won", "rt2", "Office", 5, D(2018, 3, 1)),
        ("o3", "a2", D(2018, 2, 8), D(2018, 2, 21), "Closed Lost", "rt2", "Office", 2, None),
    ], "id string, account_id string, created_date timestamp_ntz, close_date timestamp_ntz, stage_name string, "
       "record_type_id string, type_c string, no_of_desks_unweighted_c long, merged_on_c timestamp_ntz")
    ma = spark.createDataFrame([(1, "u1", D(2018, 1, 9), D(2018, 1, 10)), (2, "u2", D(2018, 2, 9), None)],
                               "id long, uuid string, created_at timestamp_ntz, signed_at timestamp_ntz")
    tours = spark.createDataFrame([(1, D(2018, 1, 3)), (2, D(2018, 2, 3))], "id long, created_at timestamp_ntz")
    f = {r.period: tuple(r)[1:] for r in wr.funnel(lead, opp, ma, tours, "2018-01-01", "2018-10-01").collect()}
    # February has no signed agreement: dropped, as the inner joins did
    assert f == {1: (1, 1, 1, 1, 1, 1)}
    rt = spark.createDataFrame([("rt1", "New Business"), ("rt2", "Renewal")], "id string, name string")
    dur = [tuple(r) for r in wr.durations(opp, rt, "2017-01-01").collect()]
    assert dur == [(2018, 1, "Hot Desk", "New Business", 1, 13.0), (2018, 2, "Office", "Renewal", 1, 13.0)]
    seg = {(r.period, r.type_id, r.segment): (r.opps, r.desks_won)
           for r in wr.segment_volumes(opp, rt, "2018-01-01", "2018-10-01").collect()}
    assert seg == {(1, "rt1", "New Business"): (1, 3), (2, "rt2", "Renewal"): (2, 5)}
    same = spark.createDataFrame([("rt1", "Renewal"), ("rt2", "Renewal")], "id string, name string")
    assert wr.segment_volumes(opp, same, "2018-01-01", "2018-10-01").count() == 2  # two types of one name
    assert [(str(r.date), r.n) for r in wr.merged_per_day(opp).collect()] == [("2018-02-07", 1)]
    v = spark.createDataFrame([("a1", 2, D(2018, 1, 2)), ("a3", 1, D(2018, 1, 3)), ("a2", -1, D(2018, 2, 3))],
                              "account_uuid string, desks_changed long, date_reserved timestamp_ntz")
    cc = [tuple(r) for r in wr.compare_counts(v, opp, "2017-07-01").collect()]
    assert cc == [(1, 1, 2, -1)]


def test_tickets_and_misc(spark):
    tag = spark.createDataFrame([(1, "Manual_x"), (1, "other"), (2, "manual_x"), (3, "enterprise")], "ticket_id long, tag string")
    ticket = spark.createDataFrame([
        (1, D(2018, 2, 1, 8), D(2018, 2, 1, 11), "root_a"), (2, D(2018, 2, 2), D(2018, 2, 3, 1), "root_a"),
        (3, D(2017, 2, 2), D(2017, 2, 3), "root_b")],
        "id long, created_at timestamp_ntz, updated_at timestamp_ntz, custom_root_cause_category string")
    te = {r.tag: (r.n, r.diff) for r in wr.tag_effort(tag, ticket, ["%manual%", "%enterprise%"], "2018-01-01").collect()}
    assert te == {"Manual_x": (1, 3.0), "manual_x": (1, 1.0)}
    assert {r.ticket_id: r.tags for r in wr.ticket_tags(tag).collect()}[1] == "Manual_x, other"
    assert {r.root: r.n for r in wr.tickets_by_root_cause(ticket).collect()} == {"root_a": 2, "root_b": 1}
    res = spark.createDataFrame([("u1", "Desk"), ("u2", "Desk"), ("u3", "Room")], "uuid string, name string")
    assert [r.name for r in wr.addon_names(res, ["u1", "u2"]).collect()] == ["Desk"]
    ex = spark.createDataFrame([(1, None, D(2018, 2, 1)), (2, "x", D(2018, 2, 1)), (3, None, D(2018, 6, 1))],
                               "id long, requests_executed string, created_at timestamp_ntz")
    assert wr.execution_errors(ex, "2018-01-01", "2018-06-01").first().n == 1
    rr = spark.createDataFrame([("New Opportunity : 7", "7"), ("Update Opportunity : 7", None),
                                ("Update Opportunity : 7", "8"), ("Update Opportunity : 7", "7")],
                               "resp string, opportunity_id_found string")
    assert sorted(r.conflict for r in wr.reuse_conflicts(rr, "resp").collect()) == [1, 2, 3]
    both = spark.createDataFrame([("New Opportunity : 1; Update Opportunity : 2", "7")], "resp string, opportunity_id_found string")
    assert sorted(r.conflict for r in wr.reuse_conflicts(both, "resp").collect()) == [1, 3]
    r = spark.createDataFrame([(1, "Global Access", D(2018, 2, 1)), (2, "Global Access", D(2018, 2, 1))],
                              "id long, description string, created_at timestamp_ntz")
    cr = spark.createDataFrame([(1, 10), (2, 10), (2, 11)], "reservation_id long, membership_agreement_id long")
    ag = spark.createDataFrame([(10, "executed", D(2018, 2, 1)), (11, "sent", D(2018, 3, 1))],
                               "id long, status string, created_at timestamp_ntz")
    assert wr.ids_in_both_statuses(r, cr, ag, "Global Access", "2018-01-01").count() == 0
    sbm = [tuple(x) for x in wr.status_by_month(r, cr, ag, "Global Access", "2018-01-01").collect()]
    assert sorted(sbm) == [(2, "executed", 2), (3, "sent", 1)]


def test_ticket_statements(spark):
    t = spark.createDataFrame([
        (1, "Please merge", D(2018, 2, 1), D(2018, 2, 2), "c", "solved"),
        (2, "merging accounts", D(2016, 1, 1), D(2016, 1, 2), "c", "solved"),
        (3, "merge old", D(2016, 1, 1), D(2016, 1, 2), "c", "open"),
        (4, "missing desk", D(2018, 3, 1), D(2018, 3, 2), "d", "solved"),
    ], "id long, subject string, created_at timestamp_ntz, updated_at timestamp_ntz, "
       "custom_digital_category string, status string")
    assert [(str(r.date), r.n) for r in wr.merge_tickets_per_day(t, "2017-01-01").collect()] == [
        ("2016-01-01", 1), ("2018-02-01", 1)]
    assert [tuple(r) for r in wr.tickets_matching_per_month(t, "%missing%", "2018-01-01").collect()] == [(3, 1)]
    assert wr.solved_tickets(t, "c", "2017-01-01", ["created_at", "updated_at"]).count() == 1


def test_requests_agreements_and_payments(spark):
    cr = spark.createDataFrame([
        (1, "u1", D(2018, 2, 1), D(2018, 2, 2), 10, "o1", "a1", "a note", "PrimaryReservation"),
        (2, "u2", D(2018, 2, 9), None, 10, "o1", "a1", None, "PrimaryReservation"),
        (3, "u3", D(2018, 3, 1), None, 11, "o2", "a2", "other", "Secondary"),
        (4, "u4", D(2017, 2, 1), None, 11, "o2", "a2", "old", "PrimaryReservation"),
    ], "id long, uuid string, created_at timestamp_ntz, executed_at timestamp_ntz, membership_agreement_id long, "
       "sf_opportunity_id string, account_uuid string, notes string, reservation_type string")
    assert [tuple(r) for r in wr.notes_share(cr, "2018-01-01").collect()] == [(2, 2, 1, 50.0)]
    assert sorted(r.id for r in wr.requests_with_notes(cr, "2018-01-01").collect()) == [1, 3]
    assert wr.primary_requests_with_notes(cr, "2018-01-01", "2018-03-01").first().n == 1
    ma = spark.createDataFrame([("m1", "a1", D(2018, 2, 1), D(2018, 2, 3)), ("m2", "a1", D(2018, 2, 2), None),
                                (None, "a2", D(2018, 2, 2), None), ("m4", "a2", D(2017, 1, 1), D(2017, 1, 2))],
                               "uuid string, account_uuid string, created_at timestamp_ntz, signed_at timestamp_ntz")
    assert wr.agreements_created(ma, "2018-01-01", "2018-03-01").first().n == 2
    account = spark.createDataFrame([("a1", "Acme", "rt1"), ("a2", "Beta", "rt2")], "uuid_c string, name string, record_type_id string")
    rt = spark.createDataFrame([("rt1", "New"), ("rt2", "Renewal")], "id string, name string")
    assert [(str(r.signed_at)[:10], r.account_name, r.record_type) for r in wr.close_durations(ma, account, rt, "2018-01-01").collect()
            ] == [("2018-02-03", "Acme", "New")]
    pm = spark.createDataFrame([(1, "card", D(2018, 2, 1)), (2, "card", D(2018, 2, 1)), (2, "bank", D(2017, 2, 1)), (9, "card", D(2018, 2, 1))],
                               "account_id long, payment_method string, created_at timestamp_ntz")
    accounts = spark.createDataFrame([(1, D(2018, 1, 2)), (2, D(2018, 1, 2))], "id long, created_at timestamp_ntz")
    assert [tuple(r) for r in wr.payment_counts(pm, accounts, "2018-01-01", "2018-03-01", "2018-01-01").collect()] == [("card", 2)]
    records = spark.createDataFrame([("a1", "m1", D(2018, 2, 1)), ("a2", "m4", D(2018, 3, 1))],
                                    "company_uuid string, membership_agreement_uuid string, created_at timestamp_ntz")
    got = wr.reuse_records_with_segment(records, account, rt, "2018-01-01", "2018-02-01").collect()
    assert [(r.membership_agreement_uuid, r.record_type) for r in got] == [("m1", "New")]
