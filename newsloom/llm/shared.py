"""Helpers that several of these operators use."""

from pyspark.sql import Column, functions as F

from newsloom.operators.checkpoints import checkpointed as written, released  # noqa: F401
from newsloom.operators.workers import on_workers  # noqa: F401


def row_id() -> Column:
    """A number of its own for each row; only for frames that are `written` next."""
    return F.monotonically_increasing_id()


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


_held: dict = {}


def held_alone(kind: tuple, make):
    """What a worker keeps from task to task, made when it is first asked for. Asking for
    another kind lets go of it, so workers that serve several operators in turn never hold the stores of two."""
    if kind not in _held:
        _held.clear()
        _held[kind] = make()
    return _held[kind]


class Kept:
    """What a worker has found for words. When there are many, those not asked for since the last time go."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def values(self, words: list[str], find) -> list:
        """The value of each word; `find` adds those of unknown words to `new`."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        out = list(map(self.new.get, words))
        gaps = [i for i, value in enumerate(out) if value is None]
        if gaps:
            unknown = {words[i] for i in gaps}
            back = self.old.keys() & unknown
            self.new.update((word, self.old[word]) for word in back)
            find(list(unknown - back))
            for i in gaps:
                out[i] = self.new[words[i]]
        return out
