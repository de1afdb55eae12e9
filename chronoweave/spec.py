"""Declarations of the sections of a stay, and the defaults that texts use."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# A field that prints as one of these words is left out.
NULL_WORDS = ("none", "nan", "nat")


@dataclass(frozen=True)
class Section:
    """One child table (or one field) of a timeline event.

    kind     "records": rows with fields; "values": a plain list; "scalar": one field
    fields   columns to print, in order (one column for values and scalars)
    time     column that says when a row becomes known; None: known with its event
    end      column with an end time that stays hidden until it has passed
    tie      columns that order rows of equal time
    spine    its times open a new snapshot
    target   a snapshot asks for its next rows
    hidden   fields that answers leave out
    mute     printed nowhere in inputs (it only serves answers)
    """

    name: str
    kind: str = "records"
    fields: tuple[str, ...] = ()
    time: str | None = None
    end: str | None = None
    tie: tuple[str, ...] = ()
    spine: bool = False
    target: bool = False
    hidden: tuple[str, ...] = ()
    mute: bool = False


@dataclass(frozen=True)
class Wording:
    """Strings of the texts; callers set their own."""

    # The forms of the title and of the head of an answer.
    title: str = "Subject Information:"
    answer: str = "Potential {section}:"
    system: str = "You read the course of a stay and say what comes next."
    questions: Mapping[str, str] = field(default_factory=dict)

    def question(self, section: str) -> str:
        return self.questions.get(section, f"Which {section} come next?")
