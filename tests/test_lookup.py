"""The kept lookup: only unseen keys are asked for, newest versions win, lost runs leave nothing half-written."""

import pytest

from tessera.plans.lookup import read_kept, refresh


def _keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "character_id string")


def _asked(answers, log):
    def look_up(keys):
        log.append(sorted(r["character_id"] for r in keys.collect()))
        return keys.sparkSession.createDataFrame([(k, h) for k, h in answers.items()], "character_id string, house string")
    return look_up


def _kept(spark, path, version=None):
    return {r["character_id"]: (r["house"], r["version"]) for r in read_kept(spark, path, version).collect()}


def test_only_unseen_keys_are_asked_for(spark, workdir):
    path, log = f"{workdir}/lookup", []
    assert _kept(spark, path) == {}
    assert refresh(spark, path, _keys(spark, "b", "a", "b", None), _asked({"a": "A1", "b": "B1", "x": "X"}, log)) == (1, 2)
    assert refresh(spark, path, _keys(spark, "a", "c", "d"), _asked({"a": "A2", "c": "C2"}, log)) == (2, 2)
    assert refresh(spark, path, _keys(spark, "d", "a"), _asked({"d": "D3"}, log)) == (2, 0)  # "d" was asked for, in vain
    assert log == [["a", "b"], ["c", "d"]]
    assert _kept(spark, path) == {"a": ("A1", 1), "b": ("B1", 1), "c": ("C2", 2), "d": (None, 2)}
    assert refresh(spark, path, _keys(spark, "a"), _asked({"d": "D3", "b": "B3"}, log), again=_keys(spark, "d", "b", "d")) == (3, 2)
    assert _kept(spark, path) == {"a": ("A1", 1), "b": ("B3", 3), "c": ("C2", 2), "d": ("D3", 3)}
    assert _kept(spark, path, 2)["d"] == (None, 2)
    assert refresh(spark, path, _keys(spark).limit(0), _asked({}, log)) == (3, 0)


def test_repeated_answers_come_together(spark, workdir):
    path = f"{workdir}/lookup"
    twice = lambda keys: keys.sparkSession.createDataFrame([("a", "beta"), ("a", "alpha"), ("a", "alphabet"), ("a", None)], "character_id string, house string")
    refresh(spark, path, _keys(spark, "a"), twice)
    assert _kept(spark, path) == {"a": ("alpha", 1)}


def test_a_lost_lookup_leaves_nothing(spark, workdir):
    path = f"{workdir}/lookup"

    def lost(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        refresh(spark, path, _keys(spark, "a"), lost)
    assert _kept(spark, path) == {} and refresh(spark, path, _keys(spark, "a"), _asked({"a": "A"}, [])) == (1, 1)
