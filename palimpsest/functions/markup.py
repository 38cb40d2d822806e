"""Reading pages as a stream of tags and text, for the Arrow batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple


class Event(NamedTuple):
    """A tag that opens (``tag``, ``attributes``), one that closes (``closes``), or text."""

    tag: str = ""
    attributes: dict[str, str] = {}
    closes: str = ""
    text: str = ""


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[Event] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append(Event(tag=tag, attributes={k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        self.events.append(Event(closes=tag))

    def handle_data(self, data: str) -> None:
        self.events.append(Event(text=data))


@lru_cache(maxsize=2)
def read(page: str | None) -> list[Event]:
    """The events of a page in order; broken markup is read as far as it goes. The last pages are kept for a second look."""
    reader = _Reader()
    reader.feed(page or "")
    reader.close()
    return reader.events


def inside(events: list[Event], at: int) -> list[Event]:
    """What stands between the opening tag at a place and the tag that closes it, or the end."""
    open_, tag = 1, events[at].tag
    for end in range(at + 1, len(events)):
        open_ += (events[end].tag == tag) - (events[end].closes == tag)
        if not open_:
            return events[at + 1 : end]
    return events[at + 1 :]


def elements(events: list[Event], wanted: Callable[[Event], bool]) -> Iterator[tuple[Event, list[Event]]]:
    """The opening tags that are wanted, each with what stands inside."""
    for at, e in enumerate(events):
        if e.tag and wanted(e):
            yield e, inside(events, at)


def said(events: list[Event], without: Callable[[Event], bool] | None = None) -> str:
    """The text of events with single spaces, tags read as spaces, without the elements that are left out."""
    words, skip = [], 0
    for at, e in enumerate(events):
        if skip > at:
            continue
        if e.tag and without and without(e):
            skip = at + len(inside(events, at)) + 2
        elif e.text:
            words.append(e.text)
        else:
            words.append(" ")
    return " ".join("".join(words).split())


def classed(tag: str, part: str) -> Callable[[Event], bool]:
    """Whether a tag has a class with the given part."""
    return lambda e: e.tag == tag and part in e.attributes.get("class", "")


def scripts(page: str | None, attribute: str, value: str) -> list[str]:
    """The content of a page's scripts with an attribute of a value; a page without the value is not read."""
    if value.lower() not in (page or "").lower():
        return []
    events = read(page)
    return ["".join(x.text for x in body) for e, body in elements(events, lambda e: e.tag == "script" and e.attributes.get(attribute, "").lower() == value.lower())]
