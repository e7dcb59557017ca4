"""What a Python worker keeps between tasks.

Workers live longer than tasks, and operators keep tables in them that are dear
to make anew: encoded words, labelled runs, opened model files.  There is one
holder for all of them.  It holds the tables of one operator at a time: the first
task of another operator drops them, so the memory of a worker is that of its
hungriest operator and not of all that have run in it.  Tables bound themselves
by bytes.  Nothing here changes a result.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Hashable

_HELD: dict = {"owner": None, "value": None}
#: Bytes of a dictionary's entry besides its key and value.
ENTRY_BYTES = 104


def trim(collect: bool = True) -> None:
    """Give freed memory back to the system."""
    if collect:
        gc.collect()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def held(owner: Hashable, make: Callable[[], object]):
    """The worker's value of ``owner``, made at first use; another owner's is dropped."""
    if _HELD["owner"] != owner:
        _HELD.update(owner=None, value=None)
        trim()
        _HELD.update(value=make(), owner=owner)
    return _HELD["value"]


def entry_bytes(key, value) -> int:
    return sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
