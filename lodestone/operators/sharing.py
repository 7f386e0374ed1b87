"""Who may hold a url together: one rule for claims and for adoptions."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Course:
    """What the sharing rule asks of a row: its variant stem and award classes."""

    stem: str
    classes: frozenset[str]

    def is_sibling_of(self, other: Course) -> bool:
        """The plain twin of :func:`lodestone.functions.names.are_siblings`."""
        return self.stem != "" and self.stem == other.stem and (not self.classes or not other.classes or not self.classes.isdisjoint(other.classes))


class Ledger:
    """The holders of each url of a site, siblings of one another and ``cap`` at most."""

    def __init__(self, courses: Iterable[tuple[str, str | None, Iterable[str]]], cap: int):
        self.courses = {who: Course(stem or "", frozenset(classes)) for who, stem, classes in courses}
        self.cap = cap
        self.holders: defaultdict[str, list[str]] = defaultdict(list)

    def objection(self, url: str, who: str) -> tuple[str, str] | None:
        """``(reason, first holder)`` if the row must not join the url's holders."""
        there = self.holders[url]
        if not there:
            return None
        if len(there) >= self.cap:
            return "cap_reached", there[0]
        own = self.courses[who]
        return None if all(own.is_sibling_of(self.courses[other]) for other in there) else ("stem_mismatch", there[0])

    def move(self, who: str, url: str, origin: str = "") -> None:
        """Let the row hold the url, and no longer the one it held."""
        if who in self.holders[origin]:
            self.holders[origin].remove(who)
        self.holders[url].append(who)
