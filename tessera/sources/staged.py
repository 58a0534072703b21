"""Several output folders that appear together or not at all.

All are written to folders of their own beside their places first. Then a journal is
written that names each move, and the folders are moved in: what is there goes to a backup,
the staged folder comes in its place. After a failure on the way all moves are undone. If
the process dies instead, the journal is still there, and the next start undoes (or, with
all folders in place, ends) what it says. The journal goes last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import DataFrame


class StagedOutputs:
    """Folders ``{name: path}`` to be written and installed as one; ``journal`` is a file beside them, one for all writers of these folders.

    Paths are of any store that pyarrow opens by its URI. With ``overwrite`` existing
    folders are replaced, otherwise they are an error before anything is written.
    """

    def __init__(self, paths: dict[str, str], journal: str, overwrite: bool = False):
        self.paths, self.journal, self.overwrite, self.run = paths, journal, overwrite, uuid.uuid4().hex[:12]
        self.repair()
        taken = [p for p in paths.values() if _exists(p)]
        if taken and not overwrite:
            raise FileExistsError(f"there already: {', '.join(taken)}")

    def staged(self, name: str) -> str:
        """Where the folder ``name`` is written until all are installed."""
        return f"{self.paths[name].rstrip('/')}.staged-{self.run}"

    def write(self, **frames: DataFrame) -> None:
        """Write frames as Parquet, install all folders, and clean up."""
        missing = set(self.paths) - set(frames)
        if missing or set(frames) - set(self.paths):
            raise ValueError(f"frames for {sorted(self.paths)} are needed, not for {sorted(frames)}")
        self.make(lambda name, path: frames[name].write.option("compression", "zstd").parquet(path))

    def make(self, write: Callable[[str, str], None]) -> None:
        """Call ``write(name, path)`` for each folder, then install all; staged folders of a failed run are removed."""
        try:
            for name in self.paths:
                write(name, self.staged(name))
            self.install()
        except BaseException:
            for name in self.paths:
                _remove(self.staged(name))
            raise

    def install(self) -> None:
        moves = [{"final": p, "staged": self.staged(n), "backup": f"{p.rstrip('/')}.backup-{self.run}", "had": _exists(p)} for n, p in self.paths.items()]
        absent = [m["staged"] for m in moves if not _exists(m["staged"])]
        if absent:
            raise FileNotFoundError(f"not written: {', '.join(absent)}")
        _write(self.journal, {"state": "installing", "moves": moves})
        try:
            for m in moves:
                if m["had"]:
                    _move(m["final"], m["backup"])
                _move(m["staged"], m["final"])
            _write(self.journal, {"state": "installed", "moves": moves})
        except BaseException:
            _undo(moves)
            _remove(self.journal)
            raise
        _finish(moves, self.journal)

    def repair(self) -> str | None:
        """End or undo what an earlier run left; ``installed``, ``undone``, or None if it left nothing."""
        if not _exists(self.journal):
            return None
        try:
            found = json.loads(_read(self.journal))
        except ValueError:  # it died while it wrote the journal: nothing was moved
            _remove(self.journal)
            return "undone"
        if found["state"] == "installed":
            _finish(found["moves"], self.journal)
            return "installed"
        _undo(found["moves"])
        for m in found["moves"]:
            _remove(m["staged"])
        _remove(self.journal)
        return "undone"


def _undo(moves: list[dict]) -> None:
    """Each place as it was; safe to repeat after a part of it."""
    for m in reversed(moves):
        if m["had"] and not _exists(m["backup"]):
            continue  # this one was never moved, or is back already
        if not _exists(m["staged"]) and _exists(m["final"]):
            _move(m["final"], m["staged"])
        if m["had"]:
            _move(m["backup"], m["final"])


def _finish(moves: list[dict], journal: str) -> None:
    for m in moves:
        _remove(m["backup"])
    _remove(journal)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _exists(path: str) -> bool:
    store, at = _store(path)
    return store.get_file_info(at).type != fs.FileType.NotFound


def _move(source: str, target: str) -> None:
    store, at = _store(source)
    store.move(at, _store(target)[1])


def _remove(path: str) -> None:
    store, at = _store(path)
    kind = store.get_file_info(at).type
    if kind == fs.FileType.Directory:
        store.delete_dir(at)
    elif kind == fs.FileType.File:
        store.delete_file(at)


def _write(path: str, value: dict) -> None:
    """The whole file or none: written beside its place and moved."""
    store, at = _store(path)
    beside = f"{at}.{uuid.uuid4().hex[:8]}"
    with store.open_output_stream(beside) as out:
        out.write(json.dumps(value, sort_keys=True).encode())
    store.move(beside, at)


def _read(path: str) -> bytes:
    store, at = _store(path)
    with store.open_input_stream(at) as held:
        return held.read()
