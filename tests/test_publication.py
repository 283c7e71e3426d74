"""Guarded publication: rivals, lost batches, rebases, failures, restores."""

import threading

import pytest

from fleetlens.sinks.publication import Conflict, Publication, Refused


@pytest.fixture
def place(spark, tmp_path):
    return Publication(spark, str(tmp_path / "published"))


def batches(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "batch bigint")


def seen(place, name="t"):
    return sorted(r.batch for r in place.table(name).collect())


def test_of_two_rivals_one_wins_and_readers_see_whole_generations(spark, place):
    first = batches(spark, 1, 2)
    place.publish({"t": first, "u": first}, first)
    ready, results = threading.Barrier(2), []

    def rival(extra):
        df = batches(spark, 1, 2, extra)
        own = Publication(spark, place.root)

        def wait():
            ready.wait(60)  # both have staged their tables and passed every check
            return True

        try:
            results.append(own.publish({"t": df, "u": df}, df, expected=1, unchanged=wait).batches)
        except Conflict:
            results.append("conflict")

    threads = [threading.Thread(target=rival, args=(n,)) for n in (7, 8)]
    for t in threads:
        t.start()
    assert seen(place) == [1, 2]
    for t in threads:
        t.join()
    assert sorted(map(str, results)) == ["3", "conflict"]
    assert place.latest().generation == 2 and seen(place) == seen(place, "u") and len(seen(place)) == 3
    assert len(place.vacuum()) == 0  # the loser has taken its tables away


def test_a_stale_reader_and_a_missing_generation_conflict(spark, place):
    one = batches(spark, 1)
    with pytest.raises(Conflict):
        place.publish({"t": one}, one, expected=4)
    place.publish({"t": one}, one)
    with pytest.raises(Conflict):
        place.publish({"t": one}, one)


@pytest.mark.parametrize("smaller", [(1, 2), (1, 2, 4)])
def test_lost_batches_are_refused_whatever_their_number(spark, place, smaller):
    place.publish({"t": batches(spark, 1, 2, 3)}, batches(spark, 1, 2, 3))
    with pytest.raises(Refused, match=r"\[3\]"):
        place.publish({"t": batches(spark, *smaller)}, batches(spark, *smaller), expected=1)
    assert place.latest().generation == 1 and seen(place) == [1, 2, 3]
    assert "[3]" in place.failures().first().error


def test_a_rebase_names_exactly_what_goes(spark, place):
    place.publish({"t": batches(spark, 1, 2, 3)}, batches(spark, 1, 2, 3))
    new = batches(spark, 1, 9)
    for removed, reason in (({2}, "r"), ({2, 3, 4}, "r"), ({2, 3}, " "), (None, "r"), (set(), "r"), ({2, 3}, None)):
        with pytest.raises(Refused):
            place.publish({"t": new}, new, expected=1, removed=removed, reason=reason)
    done = place.publish({"t": new}, new, expected=1, removed={2, 3}, reason=" source withdrew them ")
    assert (done.added, done.removed, done.reason, done.previous) == ([9], [2, 3], "source withdrew them", 1)
    assert [c.generation for c in place.history()] == [2, 1] and [c.generation for c in place.history(1)] == [2]
    assert sorted(r.batch for r in place.table("t", 1).collect()) == [1, 2, 3]


@pytest.mark.parametrize("kind", ["exception", "inputs", "empty", "null"])
def test_a_failed_publication_leaves_the_old_one(spark, place, kind):
    good = batches(spark, 1)
    place.publish({"t": good}, good)
    bad = good.selectExpr("CASE WHEN batch = 1 THEN raise_error('broken') END AS batch") if kind == "exception" else good
    scope = good.limit(0) if kind == "empty" else spark.createDataFrame([(None,)], "batch bigint") if kind == "null" else good
    with pytest.raises(Exception):
        place.publish({"t": bad}, scope, expected=1, unchanged=lambda: kind != "inputs")
    assert place.latest().generation == 1 and seen(place) == [1] and place.failures().count() == 1
    assert place.vacuum() == []
    assert place.publish({"t": good}, good, expected=1).generation == 2


def test_restore_into_an_empty_place_only(spark, place):
    df = batches(spark, 5)
    with pytest.raises(Refused):
        place.table("t")
    assert place.restore({"business": df, "catalogue": df, "profiles": df}, df).tables == ["business", "catalogue", "profiles"]
    with pytest.raises(Conflict):
        place.restore({"business": df}, df)
