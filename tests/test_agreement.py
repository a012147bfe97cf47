"""Logs and leases where neither a rename nor a creation decides between two writers."""

import json
import random
import time

import pytest

from tidemark.functions.offset_json import offset_dict
from tidemark.plans.progress import Span
from tidemark.sources.tables import FrameTable
from tidemark.streaming.agreement import Agreement, Claim, HadoopStore
from tidemark.streaming.feed import IncrementalFeed
from tidemark.streaming.lease import Lease, LeaseTaken
from tidemark.streaming.offset_log import OffsetLog
from tidemark.streaming.sinks import committed_sink, parquet_sink, read_committed


class Memory:
    """Objects by name. A listing in the order of names, as stores give them."""

    def __init__(self):
        self.objects = {}

    def put(self, name, text):
        self.objects[name] = text

    def get(self, name):
        return self.objects.get(name)

    def names(self, folder):
        return sorted(n[len(folder) + 1 :] for n in self.objects if n.startswith(folder + "/"))

    def delete(self, name):
        self.objects.pop(name, None)


def finish(steps):
    while True:
        try:
            next(steps)
        except StopIteration as done:
            return done.value


@pytest.mark.parametrize("seed", range(200))
def test_in_whatever_order_writers_act_they_decide_one_value(seed):
    rng = random.Random(seed)
    store = Memory()
    running = {w: Agreement(store, w).steps("n", None if w == "d" else f"by {w}") for w in "abcd"}
    decided = {}
    for _ in range(rng.choice([8, 30, 200])):
        if not running:
            break
        w = rng.choice(sorted(running))
        try:
            next(running[w])
        except StopIteration as done:
            decided[w] = done.value
            del running[w]
            continue
        if rng.random() < 0.01:
            del running[w]  # dies here
    for w in rng.sample(sorted(running), len(running)):
        decided[w] = finish(running[w])
    late = finish(Agreement(store, "late").steps("n", "by late"))
    values = {v for w, v in decided.items() if v is not None}
    assert len(values | {late}) == 1
    assert not any(v is None for w, v in decided.items() if w != "d")


@pytest.mark.parametrize("stop", range(12))
def test_a_writer_that_sleeps_at_any_step_wakes_to_the_value_of_others(stop):
    store = Memory()
    sleeper = Agreement(store, "sleeper").steps("n", "late")
    value = None
    for _ in range(stop):
        try:
            next(sleeper)
        except StopIteration as done:
            value = done.value
            break
    other = finish(Agreement(store, "other").steps("n", "early"))
    if value is None:
        value = finish(sleeper)
    assert value == other
    # One claim is left, which decided.
    assert [Claim.of(n).step for n in store.names("claims/n")][-1] == 2


def test_nothing_begun_is_nothing_decided():
    store = Memory()
    assert Agreement(store, "a").decide("n", None) is None
    assert Agreement(store, "b").decide("n", "mine") == "mine"
    assert Agreement(store, "a").decide("n", None) == "mine"


class Copying:
    """A file system as an object store's: a rename copies, a creation never excludes, and times cannot be set."""

    def __init__(self, fs, meanwhile=lambda: None):
        self._fs = fs
        self._meanwhile = meanwhile

    def __getattr__(self, name):
        return getattr(self._fs, name)

    def _once(self):
        meanwhile, self._meanwhile = self._meanwhile, lambda: None
        meanwhile()

    def create(self, path, _overwrite):
        self._once()
        return self._fs.create(path, True)

    def rename(self, source, target):
        self._once()
        opened = self._fs.open(source)
        text = opened.readAllBytes()
        opened.close()
        out = self._fs.create(target, True)
        out.write(text)
        out.close()
        return self._fs.delete(source, False)

    def setTimes(self, *_):  # noqa: N802
        pass


def over_copies(thing, meanwhile=lambda: None):
    """``thing`` with such a file system; what others do ``meanwhile`` comes between its look and its first write."""
    thing._fs = thing._store._fs = Copying(thing._store._fs, meanwhile)
    return thing


def two_logs(spark, folder, agreed):
    other = over_copies(OffsetLog(spark, folder, "o", agreed=agreed))
    told = []

    def plan(log, end):
        try:
            log.plan(0, Span("1", end))
            told.append(end)
        except RuntimeError as error:
            assert "another writer" in str(error)

    mine = over_copies(OffsetLog(spark, folder, "o", agreed=agreed), lambda: plan(other, "5"))
    plan(mine, "9")
    return told, mine.latest()


def test_two_writers_at_once_one_span_stands(spark, folder):
    told, latest = two_logs(spark, folder, agreed=True)
    assert len(told) == 1 and latest == (0, Span("1", told[0]), False)
    # What this is for: by renames that copy, both are told that theirs stands.
    assert two_logs(spark, f"{folder}-renamed", agreed=False)[0] == ["5", "9"]


def test_two_runners_at_once_one_gets_the_lease(spark, folder):
    other = over_copies(Lease(spark, folder, agreed=True))
    mine = over_copies(Lease(spark, folder, agreed=True), lambda: other.__enter__())
    with pytest.raises(LeaseTaken):
        mine.__enter__()
    other.check()
    with pytest.raises(LeaseTaken):
        over_copies(Lease(spark, folder, agreed=True)).__enter__()
    other.__exit__()
    with mine:
        assert mine.epoch == 1
        mine.check()
    assert HadoopStore(spark, folder).names("claims/lease") == ["1"]


def test_a_runner_that_won_the_lease_and_died_at_once_expires(spark, folder):
    dead = over_copies(Lease(spark, folder, seconds=1.0, agreed=True))
    assert dead._agreement.decide("lease/0", dead.owner) == dead.owner
    lease = over_copies(Lease(spark, folder, seconds=1.0, agreed=True))
    with pytest.raises(LeaseTaken):
        lease.__enter__()
    time.sleep(1.3)
    with lease:
        assert lease.epoch == 1


def test_a_lease_is_renewed_where_times_cannot_be_set(spark, folder):
    with over_copies(Lease(spark, folder, seconds=1.0, agreed=True)) as held:
        time.sleep(1.6)
        with pytest.raises(LeaseTaken):
            over_copies(Lease(spark, folder, seconds=1.0, agreed=True)).__enter__()
        held.check()


def feed(spark, folder, values, **options):
    table = FrameTable(lambda: spark.createDataFrame([(v,) for v in values], "o int"))
    made = IncrementalFeed(spark, table, {"offset.field": "o"}, f"{folder}/log", agreed=True, **options)
    over_copies(made.log)
    over_copies(made._lease)
    return made


def seen(spark, folder, log):
    return sorted((r.batch_id, r.o) for r in read_committed(spark, f"{folder}/out", log, spark.range(0).selectExpr("int(id) o").schema).collect())


def test_a_feed_over_copies_runs_resumes_and_replays(spark, folder):
    sink = committed_sink(f"{folder}/out")
    feed(spark, folder, [1, 2]).run_available(sink)

    class Dies(type(sink)):
        def write(self, *args):
            super().write(*args)
            raise ZeroDivisionError

    with pytest.raises(ZeroDivisionError):
        feed(spark, folder, [1, 2, 3]).run_available(Dies(f"{folder}/out"))
    last = feed(spark, folder, [1, 2, 3, 4])
    last.run_available(sink)
    assert seen(spark, folder, last.log) == [(0, 1), (0, 2), (1, 3), (2, 4)]
    assert last.log.latest() == (2, Span("3", "4"), True)


@pytest.mark.parametrize("step", range(1, 12))
def test_a_runner_that_dies_at_any_step_of_a_plan_is_followed_by_one_that_agrees(spark, folder, step):
    sink = committed_sink(f"{folder}/out")
    first = feed(spark, folder, [1, 2])
    first.run_available(sink)
    value = json.dumps({"writer": "dead", "files": {"offsets": json.dumps(offset_dict("o", "2", "3"))}})
    steps = Agreement(first.log._store, "dead").steps("offsets/1", value)
    for _ in range(step):
        if next(steps, None) is None:
            break
    last = feed(spark, folder, [1, 2, 3, 4])
    last.run_available(sink)
    rows = seen(spark, folder, last.log)
    assert [o for _, o in rows] == [1, 2, 3, 4]
    assert rows in ([(0, 1), (0, 2), (1, 3), (2, 4)], [(0, 1), (0, 2), (1, 3), (1, 4)])


def test_gathering_and_retaining_without_renames(spark, folder):
    made = feed(spark, folder, range(1, 31), rows_per_batch=1)
    made.log.gather_at, made.log.leave = 12, 3
    made.run_available(committed_sink(f"{folder}/out"))
    assert made.log.frame().count() == 30 and len(made.log._ids("offsets")) < 20
    assert [o for _, o in seen(spark, folder, made.log)] == list(range(1, 31))
    kept = feed(spark, f"{folder}-kept", range(1, 9), rows_per_batch=1, retain=2)
    kept.run_available(parquet_sink(f"{folder}-kept/out"))
    store = HadoopStore(spark, f"{folder}-kept/log")
    assert sorted(store.names("offsets")) == ["6", "7"] == sorted(store.names("claims/offsets"))


def test_a_schema_is_decided_with_its_span(spark, folder):
    log = over_copies(OffsetLog(spark, folder, "o", agreed=True))
    narrow, wide = spark.range(1).selectExpr("int(id) o").schema, spark.range(1).selectExpr("id o", "id x").schema
    log.plan(0, Span("1", "2"), narrow)
    log.plan(1, Span("2", "3"), narrow)
    log.plan(2, Span("3", "4"), wide)
    assert sorted(log._ids("schemas")) == [0, 2]
    assert log.schema(1).names == ["o"] and log.schema().names == ["o", "x"]
