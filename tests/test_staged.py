"""Folders installed together: failures at each step leave the old state whole."""

import itertools

import pytest

from tessera.sources import staged
from tessera.sources.staged import StagedOutputs


def put(path, text):
    path.mkdir(parents=True)
    (path / "part").write_text(text)


def state(root):
    return {p.name: (p / "part").read_text() if p.is_dir() else "file" for p in root.iterdir()}


def outputs(root, **more):
    return StagedOutputs({n: f"file://{root}/{n}" for n in "abc"}, f"file://{root}/journal", **more)


def write(name, path):
    from pathlib import Path

    put(Path(path.removeprefix("file://")), f"new {name}")


NEW = {n: f"new {n}" for n in "abc"}


def test_all_appear_together(tmp_path):
    outputs(tmp_path).make(write)
    assert state(tmp_path) == NEW
    with pytest.raises(FileExistsError):
        outputs(tmp_path)
    outputs(tmp_path, overwrite=True).make(lambda n, p: put(__import__("pathlib").Path(p.removeprefix("file://")), f"newer {n}"))
    assert state(tmp_path) == {n: f"newer {n}" for n in "abc"}


@pytest.mark.parametrize("failing, dies", list(itertools.product(range(5), (False, True))))
def test_a_failure_between_moves(tmp_path, monkeypatch, failing, dies):
    """a and c are there before, b isn't; the move numbered ``failing`` fails, or the process dies there."""
    put(tmp_path / "a", "old a")
    put(tmp_path / "c", "old c")
    old, moves, real = state(tmp_path), itertools.count(), staged._move

    def move(source, target):
        if next(moves) == failing:
            raise KeyboardInterrupt if dies else OSError("the store is away")
        real(source, target)

    out = outputs(tmp_path, overwrite=True)
    monkeypatch.setattr(staged, "_move", move)
    if dies:  # nothing is undone by a process that is gone
        monkeypatch.setattr(staged, "_undo", lambda moves: None)
        keep = staged._remove
        monkeypatch.setattr(staged, "_remove", lambda path: None)
    with pytest.raises(BaseException):
        out.make(write)
    monkeypatch.undo()
    if dies:
        assert (tmp_path / "journal").exists() and keep
        assert outputs(tmp_path, overwrite=True).repair() is None  # mended as it began
    assert state(tmp_path) == old
    outputs(tmp_path, overwrite=True).make(write)
    assert state(tmp_path) == NEW


def test_a_death_before_the_clean_up_is_ended(tmp_path, monkeypatch):
    put(tmp_path / "a", "old a")
    out = outputs(tmp_path, overwrite=True)
    monkeypatch.setattr(staged, "_finish", lambda moves, journal: None)
    out.make(write)
    monkeypatch.undo()
    assert (tmp_path / "journal").exists() and len(state(tmp_path)) == 5
    outputs(tmp_path, overwrite=True)
    assert state(tmp_path) == NEW


def test_a_failed_write_leaves_nothing(tmp_path):
    put(tmp_path / "a", "old a")

    def fails(name, path):
        write(name, path)
        if name == "b":
            raise OSError("no space")

    with pytest.raises(OSError):
        outputs(tmp_path, overwrite=True).make(fails)
    assert state(tmp_path) == {"a": "old a"}


def test_a_torn_journal_is_dropped(tmp_path):
    put(tmp_path / "a", "old a")
    (tmp_path / "journal").write_text('{"state": "inst')
    outputs(tmp_path, overwrite=True)
    assert state(tmp_path) == {"a": "old a"}


def test_frames(spark, tmp_path):
    out = StagedOutputs({"even": f"file://{tmp_path}/even", "odd": f"file://{tmp_path}/odd"}, f"file://{tmp_path}/journal")
    rows = spark.range(10)
    with pytest.raises(ValueError):
        out.write(even=rows)
    out.write(even=rows.filter("id % 2 = 0"), odd=rows.filter("id % 2 = 1"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["even", "odd"]
    assert spark.read.parquet(f"{tmp_path}/odd").count() == 5
