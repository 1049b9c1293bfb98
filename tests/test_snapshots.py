"""Snapshot changes on the documented dirt, nulls, repeats, empty tables and extra columns."""

import datetime as dt

from authlens.operators.authority import canonical_targets, missing_share, pivot_attributes, records
from authlens.operators.snapshots import snapshot_changes, valid_loads

ROWS = "load_id long, pos long, key_uid string, key_descriptor string, key_vocabulary string, relationship_type string, related_uid string, related_descriptor string, related_vocabulary string"
LEDGER = "load_id long, volume string, filename string, entity_type string, snapshot date, checksum string, rows_loaded int, loaded_at timestamp"


def load(n, file, day, rows, hour=0):
    return (n, "v", file, "ORGANISATION", dt.date(2026, day, 1), "x", rows, dt.datetime(2026, day, 2, hour))


def row(load_id, uid, value, pos=1, to=None, kind="Name"):
    return (load_id, pos, uid, "d", "_Organisations", kind, to, value, None)


def changes(spark, rows, loads):
    out = snapshot_changes(spark.createDataFrame(rows, ROWS), spark.createDataFrame(loads, LEDGER))
    return sorted((r.snapshot, r.uid, r.change) for r in out.collect())


def test_added_removed_changed_and_back(spark):
    loads = [load(1, "a", 1, 3), load(2, "b", 2, 3), load(3, "c", 3, 3), load(4, "c", 3, 0, 5)]
    rows = [row(1, "k1", "x"), row(1, "k2", "y"), row(2, "k1", "x2"), row(3, "k1", "x2"), row(3, "k2", "y"), row(3, "k3", "z")]
    assert changes(spark, rows, loads) == [
        ("2026-02-01", "k1", "changed"), ("2026-02-01", "k2", "removed"), ("2026-03-01", "k2", "added"), ("2026-03-01", "k3", "added"),
    ]


def test_spaces_empties_order_and_repeats_are_no_change_but_case_is(spark):
    loads = [load(1, "a", 1, 3), load(2, "b", 2, 3)]
    rows = [row(1, "k1", " a  b "), row(1, "k1", "c", 2), row(2, " k1", "c", 1, ""), row(2, "k1", "a b", 2, ""), row(2, "k1", "a b", 3), row(1, "k2", "u"), row(2, "k2", "U"), row(1, None, "q")]
    assert changes(spark, rows, loads) == [("2026-02-01", "k2", "changed")]


def test_last_load_of_a_file_counts_and_first_snapshot_is_silent(spark):
    loads = [load(1, "a", 1, 3, 1), load(2, "a", 1, 3, 2), load(3, "b", 2, 3)]
    assert changes(spark, [row(1, "k1", "old"), row(2, "k1", "new"), row(3, "k1", "new")], loads) == []
    assert changes(spark, [], []) == []


def test_guard_pivot_and_links(spark):
    loads = spark.createDataFrame([load(1, "a", 1, 3), load(2, "b", 2, 3)], LEDGER)
    rows = spark.createDataFrame([row(1, "k1", "x"), row(1, "k2", "y"), row(2, "k1", "b", 2, kind="Awards"), row(2, "k1", "a", 3, kind="Awards"), row(2, "k1", "b", 4, kind="Awards"), row(2, "k1", "t", 5, "k9", "use "), row(2, "k9", "t", 6, "k8", "Use")], ROWS).withColumn("volume_note", __import__("pyspark").sql.functions.lit(1))
    assert [(r.held, r.missing, r.refused) for r in missing_share(rows, valid_loads(loads)).collect()] == [(2, 1, True)]
    assert [r.value for r in pivot_attributes(rows).filter("attribute = 'Awards'").collect()] == ["b | a"]
    # one step only: what the preferred record prefers itself is not followed
    assert {(r.uid, r.canonical) for r in canonical_targets(rows.filter("load_id = 2")).collect()} == {("k1", "k9"), ("k9", "k8")}
    assert records(rows).count() == 4


def test_a_link_across_languages_follows_a_preferred_record_that_is_not_english(spark):
    rows = [
        (1, 1, "c1", "d", "_People_CN", "Use", "c2", "t", None), (1, 2, "c2", "d", "_People_CN", "CHItoENG", "e1", "t", None), (1, 3, "c2", "d", "_People_CN", "CHItoENG", "e0", "t", None),
        (1, 4, "e1", "d", "_People", "ENGtoCHI", "c2", "t", None), (1, 5, "e1", "d", "_People", "MAYtoENG", "e9", "t", None), (1, 6, "x", "d", "_People_TM", "Use", "gone", "t", None), (1, 7, "y", "d", None, "use", "y", "t", None),
    ]
    got = {r.uid: r.canonical for r in canonical_targets(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {"c1": "e0", "c2": "e0", "e1": "e1", "x": "gone", "y": "y"}


def test_replacement_by_a_snapshot(spark):
    from authlens.operators import replacement as R

    new = spark.createDataFrame([("a", "Alpha", "_P", "en", None, {"k": "v"}), ("b", "Beta", "_P", "en", "n", {}), ("n", "New", "_P", "en", None, {})], "uid string, name string, vocabulary string, language string, canonical_uid string, fields map<string,string>")
    old = [("a", "Alpha", "_P", "en", None, {"k": "v"}, True), ("b", "Beta", "_P", "en", None, {}, True), ("c", "Gone", "_P_CN", "zh", "a", {}, True), ("d", "Held", "_P", "en", None, {}, True), ("o", "Other", "_Q", "en", "d", {}, True), ("z", "Dead", "_P", "en", None, {}, False)]
    stored = spark.createDataFrame(old, "uid string, name string, vocabulary string, language string, canonical_uid string, fields map<string,string>, is_active boolean")
    assert {r.uid for r in R.changed(new, stored).collect()} == {"b", "n"}
    gone = R.dropped(new, stored)
    assert {r.uid for r in gone.collect()} == {"c", "d", "z"}
    matched = spark.createDataFrame([("c",), (None,)], "uid string")
    # a match holds c, another vocabulary's record points at d
    assert {(r.uid, r.action) for r in R.removal(gone, new, stored, matched).collect()} == {("c", "keep"), ("d", "keep"), ("z", "delete")}
    r = R.refusal(new, stored, gone).first()
    assert (r.active, r.silent, r.refused) == (4, 2, True)
    listed = R.dropped(new, stored, spark.createDataFrame([("c",), ("d",), ("o",)], "uid string"))
    assert {x.uid for x in listed.collect()} == {"c", "d", "o", "z"} and not R.refusal(new, stored, listed).first().refused
    assert {tuple(x) for x in R.passes(new, stored).collect()} == {("a", 1, None), ("b", 1, None), ("n", 1, None), ("b", 2, "n")}
