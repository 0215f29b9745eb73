"""What a harvester does next: the state of one repository as windows, and what follows from a page's outcome.

The plan is a small driver-side value; pages themselves are fetched and read by the sources.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

Window = tuple[str, str] | None

# How many windows a plan may grow to, how many pages and failures it takes.
WINDOWS_MOST, PAGES_MOST, FAILURES_MOST = 6000, 30_000, 5


@dataclass(frozen=True)
class Plan:
    """Windows to do (None is the whole set) with restarts so far; those done; pages and failures so far."""

    todo: tuple[tuple[Window, int], ...] = ((None, 0),)
    done: tuple[Window, ...] = ()
    skipped: tuple[Window, ...] = ()
    pages: int = 0
    failures: int = 0
    token: str | None = None
    grown: int = 1
    years: tuple[tuple[str, str], ...] = field(default=())

    @property
    def finished(self) -> bool:
        return not self.todo or self.pages >= PAGES_MOST or self.failures > FAILURES_MOST


def split(window: tuple[str, str], clamp: bool = False) -> list[tuple[str, str]]:
    """A window over 45 days by months, a shorter one by days, one of up to a day not at all."""
    begin, end = (date.fromisoformat(x) for x in window)
    days = (end - begin).days
    if days <= 1:
        return []
    if days <= 45:
        return [(d.isoformat(), d.isoformat()) for d in (begin + timedelta(k) for k in range(days + 1))]
    out = []
    for month in range(begin.year * 12 + begin.month - 1, end.year * 12 + end.month):
        y, m = divmod(month, 12)
        first, last = date(y, m + 1, 1), date(y, m + 1, calendar.monthrange(y, m + 1)[1])
        out.append(((max(first, begin) if clamp else first).isoformat(), (min(last, end) if clamp else last).isoformat()))
    return out


def after_page(plan: Plan, token: str | None) -> Plan:
    """A page came; its window is done when it has no token for the next."""
    if token:
        return replace(plan, pages=plan.pages + 1, token=token)
    (window, _), *rest = plan.todo
    return replace(plan, pages=plan.pages + 1, token=None, todo=tuple(rest), done=(*plan.done, window))


def after_expiry(plan: Plan) -> Plan:
    """The token expired. The whole set is begun again once, then goes year by year; a window is begun again twice, then split."""
    (window, restarts), *rest = plan.todo
    if restarts < (1 if window is None else 2):
        return replace(plan, token=None, todo=((window, restarts + 1), *rest))
    parts = list(plan.years) if window is None else split(window)
    if not parts or plan.grown + len(parts) > WINDOWS_MOST:
        return replace(plan, token=None, todo=tuple(rest), skipped=(*plan.skipped, window))
    return replace(plan, token=None, todo=(*((p, 0) for p in parts), *rest), grown=plan.grown + len(parts))


def after_failure(plan: Plan) -> Plan:
    """A request failed for good: the window is kept as skipped, never as done, so that nothing is lost unseen."""
    (window, _), *rest = plan.todo
    return replace(plan, failures=plan.failures + 1, token=None, todo=tuple(rest), skipped=(*plan.skipped, window))
