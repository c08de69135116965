"""A bounded memory of what a worker has worked out for strings."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import islice


def trim(memory: dict, learned: Iterable[str], entries: int, chars: int) -> None:
    """Forget long strings just learned and, beyond ``entries``, the half learned last.

    Frequent strings are met early, so the older half is the one worth keeping.
    """
    for key in learned:
        if len(key) > chars:
            del memory[key]
    if len(memory) > entries:
        for key in list(islice(reversed(memory), len(memory) - entries // 2)):
            del memory[key]
