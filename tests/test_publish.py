import json

import pytest

from granary.operators.contracts import ContractError, require_unique
from granary.plans.fingerprint import compare, measure, update_baseline
from granary.plans.publish import COMMITS, LEASE, VERSIONS, Job, Lease, PublishError, Store, commits, current, load, publish
from granary.sources.tables import describe_files, literal, read_table, register, same_rows, write_verified


@pytest.fixture
def source(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    return {"numbers": f"{tmp_path}/in"}


def jobs(k=1):
    return [Job("a", lambda t: t["numbers"].selectExpr(f"id * {k} as x"), lambda df: require_unique(df, ["x"])), Job("b", lambda t: t["a"].selectExpr("x + 1 as y"))]


def test_publish_load_and_refuse(spark, tmp_path, source):
    target = f"{tmp_path}/out"
    with pytest.raises(PublishError, match="nothing was published"):
        load(spark, target)
    manifest = publish(spark, target, source, jobs(2), code="v1")
    assert manifest["tables"]["b"]["rows"] == 10
    assert load(spark, target, "v1")["b"].agg({"y": "max"}).first()[0] == 19
    with pytest.raises(PublishError, match="other code"):
        load(spark, target, "v2")
    spark.range(3).selectExpr("id as x").write.mode("overwrite").parquet(current(spark, target).paths()["a"])
    with pytest.raises(PublishError, match="not what was published"):
        load(spark, target)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == [COMMITS, VERSIONS]
    assert sorted(p.name for p in (tmp_path / "out/commits").iterdir() if not p.name.startswith(".")) == ["0000000001.json"]


def test_failures_leave_the_published_set(spark, tmp_path, source):
    target = f"{tmp_path}/out"
    publish(spark, target, source, jobs(2))
    with pytest.raises(ContractError):
        publish(spark, target, source, [jobs(0)[0]])
    assert load(spark, target)["a"].agg({"x": "max"}).first()[0] == 18 and len(list((tmp_path / "out/versions").iterdir())) == 1
    (tmp_path / "link").symlink_to(tmp_path / "in")
    for inside in (f"{tmp_path}/in/out", f"{tmp_path}/x/../in/out", f"file://{tmp_path}/in", f"{tmp_path}/link/out", str(tmp_path)):
        with pytest.raises(PublishError, match="overlaps"):
            publish(spark, inside, source, jobs())
    publish(spark, f"{tmp_path}/in-beside", source, jobs())


class Dies:
    """The k-th call to the store, and every one after it, fails as in a process that was killed: nothing is cleared up."""

    def __init__(self, monkeypatch, k):
        self.left, self.last = k, None
        for name in ("write", "delete", "rename_new", "files", "names", "read"):
            monkeypatch.setattr(Store, name, self.wrapped(name, getattr(Store, name)))

    def wrapped(self, name, f):
        def call(*args, **kwargs):
            self.left -= 1
            if self.left <= 0:
                self.last = self.last or name
                raise KeyboardInterrupt("killed")
            return f(*args, **kwargs)

        return call


def test_a_writer_killed_at_any_step_leaves_the_old_set_or_the_new_one(spark, tmp_path, source, monkeypatch):
    target, steps, seen, k = f"{tmp_path}/out", set(), set(), 0
    one = [Job("a", lambda t: t["numbers"].selectExpr("id * 2 as x").coalesce(1))]
    publish(spark, target, source, one)
    while k < 80:
        k += 1
        with monkeypatch.context() as patched:
            dies = Dies(patched, k)
            try:
                publish(spark, target, source, [Job("a", lambda t, k=k: t["numbers"].selectExpr(f"id * 2 + {k} * 100 as x").coalesce(1))], lease_seconds=0.0)
            except KeyboardInterrupt:
                steps.add(dies.last)
            else:
                break
        got = load(spark, target)["a"].agg({"x": "max"}).first()[0]  # checks files, rows and columns too
        seen.add("new" if got == 18 + 100 * k else "old")
        assert got == 18 + 100 * k or got < 18 + 100 * k
        assert (got - 18) % 100 == 0
    assert load(spark, target)["a"].agg({"x": "max"}).first()[0] == 18 + 100 * k
    assert seen == {"old", "new"} and steps >= {"write", "delete", "rename_new", "files", "names"} and k > 12
    assert len(Store(spark, target).names(VERSIONS)) <= 2 and not Store(spark, target).exists(LEASE)


def test_of_two_writers_one_wins(spark, tmp_path, source):
    target = f"{tmp_path}/out"

    def publish_within(seconds):
        def build(t):
            publish(spark, target, source, jobs(5), lease_seconds=seconds)
            return t["numbers"].selectExpr("id as x")

        return [Job("a", build)]

    with pytest.raises(PublishError, match="is being written until"):  # the second gives up before it builds anything
        publish(spark, target, source, publish_within(60))
    assert current(spark, target) is None
    with pytest.raises(PublishError, match="another writer published meanwhile"):  # the first one's lease had run out
        publish(spark, target, source, publish_within(60), lease_seconds=-1)
    assert load(spark, target)["a"].agg({"x": "max"}).first()[0] == 45
    assert [n for n, _ in commits(Store(spark, target))] == [1] and len(Store(spark, target).names(VERSIONS)) == 1


def test_create_is_for_one(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = Store(spark, f"{tmp_path}/s")
    with ThreadPoolExecutor(8) as pool:
        won = [i for i, ours in enumerate(pool.map(lambda i: store.create("c/x", str(i)), range(16))) if ours]
    assert len(won) == 1 and store.read("c/x") == str(won[0]) and store.names("c") == ["x"]


def test_lease_is_renewed_and_taken_over(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    with Lease(store, 60) as a:
        assert a.held()
        a.renew()
        with pytest.raises(PublishError, match="is being written"):
            Lease(store, 60).__enter__()
    assert not store.exists(LEASE)
    late = Lease(store, -1).__enter__()
    with Lease(store, 60) as b:
        assert b.held() and not late.held()
        late.renew()
        late.__exit__()
        assert b.held()


def test_readers_keep_their_set_through_the_next_commit(spark, tmp_path, source):
    target = f"{tmp_path}/out"
    publish(spark, target, source, jobs(1))
    old = current(spark, target)
    publish(spark, target, source, jobs(2))
    assert load(spark, target, found=old)["a"].agg({"x": "max"}).first()[0] == 9 and current(spark, target).number == 2
    publish(spark, target, source, jobs(3))
    with pytest.raises(PublishError, match="other files"):
        load(spark, target, found=old)


def test_changed_input_is_noticed(spark, tmp_path, source):
    def build(t):
        spark.range(11).write.mode("overwrite").parquet(source["numbers"])
        return spark.range(2)

    with pytest.raises(PublishError, match="input changed"):
        publish(spark, f"{tmp_path}/out", source, [Job("a", build)])


def test_changed_code_and_contents_are_noticed(spark, tmp_path, source):
    versions = iter(["v1", "v2"])
    with pytest.raises(PublishError, match="code changed"):
        publish(spark, f"{tmp_path}/out", source, jobs(), code=lambda: next(versions))
    manifest = publish(spark, f"{tmp_path}/out", source, jobs(), code=lambda: "v3", hashed=True)
    assert manifest["code"] == "v3" and load(spark, f"{tmp_path}/out", "v3")["a"].count() == 10
    found = current(spark, f"{tmp_path}/out")
    found.manifest["tables"]["a"]["fingerprint"]["hash_xor"] += 1
    with pytest.raises(PublishError, match="other contents"):
        load(spark, f"{tmp_path}/out", found=found)
    Store(spark, found.path).write("_manifest.json", json.dumps(found.manifest))
    with pytest.raises(PublishError, match="not the published one"):
        load(spark, f"{tmp_path}/out")


def test_measures_go_to_the_manifest(spark, tmp_path, source):
    job = Job("a", lambda t: t["numbers"], measure=lambda df, t, seen: {"rows": seen["rows"], "of": t["numbers"].count()})
    manifest = publish(spark, f"{tmp_path}/out", source, [job], cross_check=lambda t: {"tables": len(t)})
    assert manifest["tables"]["a"]["metrics"] == {"rows": 10, "of": 10} and manifest["metrics"] == {"tables": 2}


def test_baseline(spark, tmp_path):
    df = spark.range(5)

    def now(metric=lambda: 1, invariant=lambda: 0, table=df):
        return measure({"t": table}, {"m": metric}, {"i": invariant})

    update_baseline(now(), tmp_path / "b.json")
    base = json.loads((tmp_path / "b.json").read_text())
    assert compare(now(), base) == []
    assert len(compare(now(metric=lambda: 2), base)) == 1
    assert compare(now(invariant=lambda: 3), base) == ["invariant i is 3"]
    assert "tables t" in compare(now(table=spark.range(6)), base)[0]
    assert "error: ZeroDivisionError" in compare(now(metric=lambda: 1 // 0), base)[0]
    with pytest.raises(ValueError, match="not a baseline"):
        update_baseline(now(invariant=lambda: 1), tmp_path / "b.json")


def test_sources(spark, tmp_path):
    df = literal(spark, [(2, "b"), (1, "a"), (3, None)], "k int, v string")
    back = write_verified(df, f"{tmp_path}/t.parquet", ["k"], ["k"])
    assert same_rows(back, df) and not same_rows(back, df.where("k > 1"))
    assert describe_files(back)["rows"] == 3
    with pytest.raises(ContractError, match="repeated"):
        write_verified(df.unionAll(df), f"{tmp_path}/u", ["k"])
    register(spark, {"registered": read_table(spark, str(tmp_path), "t", df.schema)})
    assert spark.sql("SELECT count(*) FROM registered").first()[0] == 3


def test_snapshot_is_whole_and_kept(spark, tmp_path):
    from granary.sources.extract import jdbc_readers, open_snapshot, snapshot

    target, readers = f"{tmp_path}/raw", {"a": lambda: spark.range(4), "b": lambda: spark.range(2).selectExpr("id as x")}
    assert snapshot(spark, target, readers)["tables"]["a"]["rows"] == 4
    with pytest.raises(PublishError, match="holds a snapshot"):
        snapshot(spark, target, readers)

    def broken():
        raise OSError("connection lost")

    with pytest.raises(OSError, match="connection lost"):
        snapshot(spark, target, readers | {"b": broken}, replace=True)
    assert open_snapshot(spark, target)["a"].count() == 4
    snapshot(spark, target, {"a": lambda: spark.range(5)}, replace=True)
    assert open_snapshot(spark, target)["a"].count() == 5
    spark.range(1).write.mode("overwrite").parquet(current(spark, target).paths()["a"])
    with pytest.raises(PublishError, match="not what was published"):
        open_snapshot(spark, target)
    assert set(jdbc_readers(spark, "jdbc:postgresql://h/d", {"a": "public.a"}, {})) == {"a"}


def test_database(spark, tmp_path):
    """Spark brings an embedded database along: tables are read in parts, with a limit of time, and its catalog is asked."""
    from granary.sources.extract import jdbc_readers, open_snapshot, snapshot
    from granary.sources.tables import read_catalog, read_jdbc

    url, properties = "jdbc:derby:memory:prices;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(20).selectExpr("id as k", "cast(id * 2 as double) as v").write.jdbc(url, "prices", properties=properties)
    whole, parts = read_jdbc(spark, url, "prices", properties), read_jdbc(spark, url, "prices", properties, 10, ("k", 0, 20, 4))
    assert whole.count() == 20 and parts.rdd.getNumPartitions() == 4 and same_rows(whole, parts)
    assert read_jdbc(spark, url, '(SELECT "k" FROM prices WHERE "v" > 30) q', properties).count() == 4
    rows = read_catalog(spark, url, properties, "SELECT TABLENAME AS table_name FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'").collect()
    assert [r[0] for r in rows] == ["PRICES"]
    snapshot(spark, f"{tmp_path}/raw", jdbc_readers(spark, url, {"prices": "prices"}, properties))
    assert open_snapshot(spark, f"{tmp_path}/raw")["prices"].count() == 20
