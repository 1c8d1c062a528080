"""Stand-in datasets conform to the declared schemas (names and types of the shared columns)."""

from statsweep.sources import bindings as B
from statsweep.sources.schemas import DATASETS, NATURAL_KEYS, schema

SF = "/root/testdata/sf0.001"


def _check(df, dataset):
    declared = {f.name: f.dataType for f in schema(dataset).fields}
    got = {f.name: f.dataType for f in df.schema.fields}
    shared = set(declared) & set(got)
    assert len(shared) >= 3, (dataset, sorted(got))
    bad = {c: (str(got[c]), str(declared[c])) for c in shared if got[c] != declared[c]}
    assert not bad, (dataset, bad)


def test_all_schemas_parse_and_keys_exist(spark):
    for name in DATASETS:
        fields = {f.name for f in schema(name).fields}
        for k in NATURAL_KEYS.get(name, ()):
            assert k in fields or k == "server_id", (name, k)


def test_bindings_conform(spark):
    t = lambda n: B.table(spark, SF, n)
    ev = t("events")
    _check(B.sessions(ev), "sessions")
    _check(B.locks(t("customer")), "locks")
    _check(B.relations(t("nation")), "relations")
    _check(B.buffers(t("lineitem")), "buffers")
    _check(B.plans(t("part")), "plans")
    _check(B.window_waits_input(spark, ev), "window_waits")
    _check(B.setting_overrides(t("orders")), "setting_overrides")
    _check(B.pool_servers(ev), "pool_servers")
    _check(B.metric_series(spark, ev), "minute_metrics")
