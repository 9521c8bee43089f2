"""Job parameters used by the bindings (dates, sizes, id lists).

These are parameters of the queries, not row caps: every query reads its whole
input tables."""

import datetime as _dt
from contextlib import contextmanager
from contextvars import ContextVar

AS_OF = _dt.date(2024, 1, 16)        # job date for the event-table jobs
PROFILE_AS_OF = _dt.date(2024, 1, 31)  # as-of date for the decayed profile
RANGE_DAYS = 15                        # days between the bounds of the action range that ends at the job date
TOP_K = 500                            # catalogue top-K (reference: 30,000)
FLAG_APPS = (1, 7, 42)                 # apps whose install sets a flag
STUDENT_APPS = (3, 11, 19)             # apps that mark a student
IT_APPS = (5,)                         # apps that mark IT
BADCASE_PER_LABEL = 20                 # bad-case sample size per label (reference: 500)
MIN_SUPPORT = 120                      # minimum class support (reference: 10,000)
GUARD_MIN_ROWS = 1000                  # guarded write threshold
SPLIT_HEX = "cccccccc"                 # md5 prefix below this -> train (0.8)
TRAIN_MIN_SUPPORT = 10                 # class support needed in exported training lines
TRAIN_MONTHS = -18                     # window of the content training lines, in months before the job date
TRAIN_SOURCE = "src2"                  # source of the content training lines
NEGATIVE_FRACTION = 0.3                # share of the negatives kept in a training set
FILE_BYTES = 64 << 20                  # wanted size of an exported file
TEXT_BITS = 15                         # hashed text features: 2^15 for each of eight classes
POOR_SHEET = 120000                    # orders below this price leave the second answer empty

_job_day: ContextVar[_dt.date | None] = ContextVar("job_day", default=None)


def as_of() -> _dt.date:
    """The running job's date (of this thread of work alone), else AS_OF."""
    return _job_day.get() or AS_OF


def job_date() -> _dt.date | None:
    """The running job's date; None outside a dated job."""
    return _job_day.get()


def profile_as_of() -> _dt.date:
    return _job_day.get() or PROFILE_AS_OF


@contextmanager
def job_day(day: _dt.date):
    """Queries built inside are those of that day, whatever other jobs of the
    process run."""
    token = _job_day.set(day)
    try:
        yield
    finally:
        _job_day.reset(token)
