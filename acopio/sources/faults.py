"""What went wrong with a file: it is missing, refused or unreadable, or its store cannot be reached.

The first three are facts about one file and become a row. The last one says nothing about the
file: it is tried again a few times, and then the run fails instead of taking every file for bad.
"""

from __future__ import annotations

import errno
import re
import time
from collections.abc import Callable
from typing import TypeVar

MISSING, REFUSED, UNREADABLE, UNREACHABLE = "missing", "refused", "unreadable", "unreachable"
#: Seconds before each further try.
WAITS = (0.2, 1.0, 3.0)

_REFUSED = re.compile(r"access.?denied|forbidden|unauthori[sz]ed|permission denied|\b40[13]\b", re.I)
_UNREACHABLE = re.compile(
    r"network|throttl|slow.?down|timed? ?out|timeout|connection|could ?n.t (resolve|connect)|unknown ?host|unavailable|too many requests|internal.?(server )?error|\b(429|50[0234])\b|curlcode",
    re.I,
)
_NUMBERS = {
    **dict.fromkeys((errno.ENOENT, errno.ENOTDIR), MISSING),
    **dict.fromkeys((errno.EACCES, errno.EPERM), REFUSED),
    **dict.fromkeys(
        (errno.ETIMEDOUT, errno.ECONNREFUSED, errno.ECONNRESET, errno.ECONNABORTED, errno.ENETUNREACH, errno.ENETDOWN, errno.EHOSTUNREACH, errno.EHOSTDOWN,
         errno.EPIPE, errno.EAGAIN, errno.EBUSY, errno.ESTALE, errno.EMFILE, errno.ENFILE, errno.EIO),
        UNREACHABLE,
    ),
}

T = TypeVar("T")


class StoreUnreachable(Exception):
    """The store did not answer in all tries. Not a fault of the file."""


def fault_of(exc: BaseException) -> str:
    """Which of the four an exception of a file operation is."""
    if isinstance(exc, StoreUnreachable):
        return UNREACHABLE
    if isinstance(exc, OSError) and type(exc).__name__ != "BadGzipFile":
        if exc.errno in _NUMBERS:
            return _NUMBERS[exc.errno]
        if isinstance(exc, (ConnectionError, TimeoutError)) or _UNREACHABLE.search(f"{exc}"):
            return UNREACHABLE
        if isinstance(exc, FileNotFoundError):
            return MISSING
        if isinstance(exc, PermissionError) or _REFUSED.search(f"{exc}"):
            return REFUSED
    return UNREADABLE


def tried(work: Callable[[], T], waits: tuple[float, ...] | None = None) -> T:
    """``work`` done, again if the store could not be reached; the faults of a file are raised at once."""
    for wait in (*(WAITS if waits is None else waits), None):
        try:
            return work()
        except Exception as exc:
            if fault_of(exc) != UNREACHABLE:
                raise
            if wait is None:
                raise StoreUnreachable(f"store not reached in {len(WAITS) + 1} tries: {exc}") from exc
            time.sleep(wait)
    raise AssertionError("not reached")


#: Conditions under which Spark refuses a scan because of a file in it.
_OF_A_FILE = re.compile(
    r"PATH_NOT_FOUND|UNABLE_TO_INFER_SCHEMA|FAILED_READ_FILE|CANNOT_READ_FILE_FOOTER|CANNOT_MERGE_SCHEMAS|FAILED_MERGE_FIELDS|MALFORMED_|INVALID_JSON|PARQUET_|"
    r"is not a Parquet file|[Cc]ould not read footer|FileNotFoundException|does not exist|ColumnTypes|COLUMN_ALREADY_EXISTS|CharacterCodingException|ZipException|not in gzip|EOFException"
)


def refuses_a_file(exc: BaseException) -> bool:
    """True when Spark refuses a scan for something in its files, and false for lost executors, outages and all else."""
    text = f"{exc}"
    if fault_of(exc) == UNREACHABLE or re.search(r"UnknownHostException|SocketTimeout|ConnectException|SlowDown|AWSBadRequest|Status Code: (403|429|5\d\d)", text):
        return False
    return bool(_OF_A_FILE.search(text)) or type(exc).__name__ == "AnalysisException"
