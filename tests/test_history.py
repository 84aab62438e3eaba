import itertools

from pyspark.sql import functions as F

from rowlake.operators.profile import as_kept, merged, profile_columns, profile_typed
from rowlake.operators.shape import route_physical, route_typed
from rowlake.plans.fanout import fan_out
from rowlake.plans.history import drifted, merged_profile, system_lake
from rowlake.sources.envelope import decode_envelope, decode_envelope_typed
from test_flow import envelope, log


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


ENVELOPES = [
    envelope("a.csv", {"d": "", "e": "2024-01-01", "n": 1}), envelope("a.csv", {"d": "2024-01-01", "e": "x", "n": 2.5}),
    envelope("b.csv", {"k": "1"}, None), envelope("a.csv", {"d": "x", "n": "three"}), envelope("c.csv", None),
    envelope("a.csv", {"d": "2024-01-02", "e": "2024-01-01", "n": True}),
]


def test_any_split_into_batches_merges_to_the_whole(spark):
    whole = log(spark, *ENVELOPES)
    for decode, route, profile in (
        (decode_envelope, route_physical, lambda r: profile_columns(r)),
        (decode_envelope, route_physical, lambda r: profile_columns(r, packed=True)),
        (decode_envelope_typed, route_typed, profile_typed),
    ):
        expected = rows(merged(as_kept(profile(route(decode(whole)))), 0.95))
        for split in itertools.islice(itertools.product((0, 1, 2), repeat=3), 0, 27, 9):
            part = F.expr(f"{split[0]} + offset * {split[1] + 1} + partition * {split[2] + 1}") % 3
            parts = [as_kept(profile(route(decode(whole.where(part == i))))) for i in (2, 0, 1)]
            assert rows(merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), 0.95)) == expected


def test_history_beside_the_tables(spark, lake):
    assert merged_profile(lake).isEmpty() and drifted(lake).isEmpty()
    first = log(spark, envelope("a.csv", {"d": "2024-01-01"}), envelope("b.csv", {"k": "x"}))
    second = log(spark, envelope("a.csv", {"d": "2024-01-02"}), envelope("b.csv", {"k": "2024-02-02"}, *[{"k": "2024-02-02"}] * 30))
    for batch_id, batch in ((0, first), (1, second.withColumn("offset", F.col("offset") + 9)), (1, second.withColumn("offset", F.col("offset") + 9))):
        fan_out(route_physical(decode_envelope(batch)), lake, "s", batch_id, mode="bulk", history=lake)
    found = {r.column_name: (r.non_null, r.date_hits, r.verdict) for r in merged_profile(lake).collect()}
    assert found == {"d": (2, 2, "date"), "k": (32, 31, "date")}
    assert rows(drifted(lake)) == [("b", "k", "string", "date")]
    assert sorted(lake.table_names()) == ["a", "b"] and system_lake(lake).table_names() == ["profiles"]
