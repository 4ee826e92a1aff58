"""Records out of HTML listings: a small element tree, selectors of tags and classes, and one field list a page plan.

Selectors and classes are fixed values of the pages. Each page is one row, so pages are parsed where they lie, in Arrow batches, without a shuffle. A page that yields nothing
gives one row with its length, so that nothing is lost without a trace.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import date
from functools import cache, lru_cache
from html import unescape
from html.parser import HTMLParser
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.shipping import ship

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Index:
    """Elements of a page in document order, by tag and by class."""

    def __init__(self) -> None:
        self.count = 0
        self.by: dict[str, tuple[list[int], list[Element]]] = {}

    def add(self, x: Element) -> None:
        x.index, x.place = self, self.count
        self.count += 1
        for k in (x.tag, "", *{f".{c}" for c in x.classes}) if x.classes else (x.tag, ""):
            known = self.by.get(k)
            if known is None:
                self.by[k] = ([x.place], [x])
            else:
                known[0].append(x.place)
                known[1].append(x)

    def below(self, x: Element, key: str) -> list[Element]:
        """Those under a key that lie below an element, in document order."""
        places, elements = self.by.get(key, ([], []))
        return elements[bisect_right(places, x.place) : bisect_left(places, x.end)]


@dataclass(eq=False, slots=True)
class Element:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    classes: list[str] = field(init=False)
    children: list[Element | str] = field(default_factory=list)
    parent: Element | None = None
    #: place in document order, and that after the last element below
    place: int = 0
    end: int = 0
    index: Index | None = None

    def __post_init__(self) -> None:
        self.classes = self.attrs["class"].split() if "class" in self.attrs else []

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                todo.extend(reversed(x.children))
        return "".join(out)

    def walk(self) -> Iterator[Element]:
        """Elements below, in document order."""
        yield from self.index.below(self, "")

    def select(self, selector: str) -> Iterator[Element]:
        """Elements that match "tag.class:not(.class)" parts, each below the one before."""
        *outer, last = parts_of(selector)
        for x in self.index.below(self, f".{last.has[0]}" if last.has else last.tag):
            if last.fits(x):
                rest, a = list(outer), x.parent
                while rest:
                    if rest[-1].fits(a):
                        rest.pop()
                    if a is self:
                        break
                    a = a.parent
                if not rest:
                    yield x

    def first(self, selector: str) -> Element | None:
        return next(self.select(selector), None)


@dataclass
class Simple:
    tag: str
    has: list[str]
    lacks: list[str]

    @classmethod
    def of(cls, text: str) -> Simple:
        text, _, no = text.partition(":not(")
        tag, *has = text.split(".")
        return cls(tag, has, [c for c in no.rstrip(")").split(".") if c])

    def fits(self, x: Element) -> bool:
        return (not self.tag or x.tag == self.tag) and all(c in x.classes for c in self.has) and not any(c in x.classes for c in self.lacks)


@cache
def parts_of(selector: str) -> tuple[Simple, ...]:
    return tuple(Simple.of(s) for s in selector.split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.index = Index()
        self.root = Element("")
        self.index.add(self.root)
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "p" and any(x.tag == "p" for x in self.open[-2:]):
            self.handle_endtag("p")
        x = Element(tag, {k: v or "" for k, v in attrs}, parent=self.open[-1])
        self.index.add(x)
        x.end = x.place + 1
        self.open[-1].children.append(x)
        if tag not in _VOID:
            self.open.append(x)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.closed(i)
                return

    def closed(self, i: int) -> None:
        for x in self.open[i:]:
            x.end = self.index.count
        del self.open[i:]

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


_ATTRIBUTE = re.compile(r'[ \n]([a-z][a-z-]*)(?:="([^"&<>]*)")?')
#: A start tag, an end tag, or text up to the next tag, as plain pages have them
_PLAIN = re.compile(r'<([a-z][a-z0-9]*)((?:[ \n][a-z][a-z-]*(?:="[^"&<>]*")?)*)>|</([a-z][a-z0-9]*)>|([^<]+)')
#: What is inside these is no markup for the parser
_RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp plaintext".split())


def _plain(html: str) -> Element | None:
    """The tree of a page that is made of plain tags and text alone, some times as fast; None for any other page."""
    builder = _Builder()
    start, end, data, at, raw = builder.handle_starttag, builder.handle_endtag, builder.open, 0, None
    for m in _PLAIN.finditer(html):
        if m.start() != at:
            return None
        at = m.end()
        opened, attributes, closed, text = m.groups()
        if raw is not None and opened is not None or closed is not None and raw not in (None, closed):
            return None
        if text is not None:
            data[-1].children.append(text if raw or "&" not in text else unescape(text))
        elif opened is not None:
            attrs = _ATTRIBUTE.findall(attributes) if attributes else []
            if len({k for k, _ in attrs}) < len(attrs):
                return None
            start(opened, attrs)
            if opened in _RAW:
                if opened not in ("script", "style"):
                    return None
                raw = opened
        else:
            raw = None
            end(closed)
    if at != len(html) or raw is not None:
        return None
    builder.closed(0)
    return builder.root


def tree(html: str) -> Element:
    root = _plain(html)
    if root is not None:
        return root
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder.closed(0)
    return builder.root


Record = tuple[str, dict]
#: What a plan finds of an item: texts and attributes as they are, and whether something is there
Find = tuple[str | bool | None, ...]

#: Texts and values of attributes that no selector asks for; what lies between them is the layout
_SLOT = re.compile(r'(?:>(?=[^<])|="(?<!class=")(?<![ \n]id="))((?<=>)[^<]+|(?<=")[^"&<>]*(?="))')
#: Layouts and openings of pages that a worker remembers, and characters of one
_REMEMBERED, _LONGEST = 1024, 4096


def _part(html: str) -> tuple[Element, list[Element], bool] | None:
    """The tree of a part of a page, which elements it leaves open, and whether it closes some that it has not opened, after which
    none begins. None if it is not plain, or does not close elements one by one as they were opened."""
    builder, at, ends = _Builder(), 0, False
    for m in _PLAIN.finditer(html):
        opened, attributes, closed, text = m.groups()
        if m.start() != at:
            return None
        at, last = m.end(), builder.open[-1]
        if text is not None:
            last.children.append(text)
        elif opened is not None:
            attrs = _ATTRIBUTE.findall(attributes)
            if ends or opened in _RAW or len({k for k, _ in attrs}) < len(attrs) or opened == "p" and any(x.tag == "p" for x in builder.open[-2:]):
                return None
            builder.handle_starttag(opened, attrs)
        elif len(builder.open) == 1:
            ends = True
        elif closed == last.tag:
            builder.closed(len(builder.open) - 1)
        else:
            return None
    if at != len(html):
        return None
    opened = builder.open[1:]
    builder.closed(0)
    return builder.root, opened, ends


@lru_cache(_REMEMBERED)
def _layout(look: Callable[[Element], Iterator[Find]], between: tuple[str, ...]) -> tuple[list, list[tuple[int, ...]], list[Callable], bool] | None:
    """What a plan finds in a part of a page, by what lies between its slots: constants, texts that are several slots, a find's
    places among slots, constants and such texts, and whether the part ends what was open before. None if the part is not plain."""
    if any("\0" in x for x in between):
        return None
    part = _part(between[0] + "".join(('="' if x[:1] == '"' else ">") + f"\0{i}\0{x}" for i, x in enumerate(between[1:])))
    if part is None or part[1]:
        return None
    slots, finds = len(between) - 1, [[tuple(map(int, v.split("\0")[1::2])) if isinstance(v, str) and "\0" in v else v for v in find] for find in look(part[0])]
    constants = list({(type(v), v): v for find in finds for v in find if not isinstance(v, tuple)}.values())
    joined = list(dict.fromkeys(v for find in finds for v in find if isinstance(v, tuple) and len(v) > 1))
    place = {(type(v), v): slots + i for i, v in enumerate([*constants, *joined])}
    return constants, joined, [itemgetter(*[v[0] if isinstance(v, tuple) and len(v) == 1 else place[type(v), v] for v in find]) for find in finds], part[2]


@lru_cache(_REMEMBERED)
def _opens(look: Callable[[Element], Iterator[Find]], area: str | None, before: str) -> bool:
    """Whether what comes before a page's items is plain, has none itself, and leaves the area of items open."""
    part = _part(before)
    if part is None or part[2] or any(x.tag == "p" for x in part[1]):
        return False
    return not any(True for _ in look(part[0])) if area is None else bool(part[1]) and part[0].first(area) is part[1][-1]


@dataclass(frozen=True)
class Listed:
    """A plan for pages that list items in an area: look finds their texts below an element, say makes records of what was
    found. Items begin at a mark at the latest; those of one layout are looked at once, and their texts are put in."""

    mark: re.Pattern
    look: Callable[[Element], Iterator[Find]]
    say: Callable[[Iterable[Find], date], Iterator[Record]]
    area: str | None = None

    def __call__(self, page: Element, as_of: date) -> Iterator[Record]:
        area = page if self.area is None else page.first(self.area)
        return self.say(() if area is None else self.look(area), as_of)

    def finds(self, html: str) -> list[Find] | None:
        """What look finds in a page, by the layouts of its parts; None for a page that is to be read as a tree."""
        starts = [m.start() for m in self.mark.finditer(html)]
        if not starts or starts[0] > _LONGEST or not _opens(self.look, self.area, html[: starts[0]]):
            return None
        out: list[Find] = []
        starts.append(len(html))
        for start, end in zip(starts, starts[1:]):
            part = html[start:end]
            if len(part) > _LONGEST:
                return None
            pieces = _SLOT.split(part)
            layout = _layout(self.look, tuple(pieces[::2]))
            if layout is None or layout[3] and end < len(html):
                return None
            constants, joined, places, _ = layout
            row = [unescape(v) if "&" in v else v for v in pieces[1::2]] if "&" in part else pieces[1::2]
            texts = ["".join([row[i] for i in at]) for at in joined]
            row += constants
            row += texts
            out += [find(row) for find in places]
        return out


def _raw(x: Element, selector: str) -> str | None:
    found = x.first(selector)
    return None if found is None else found.text()


def warmup_events(page: Element, as_of: date) -> Iterator[Record]:
    """Calendar widgets in the page's warm-up JSON."""
    for script in page.select("script"):
        if script.attrs.get("id") == "wix-warmup-data":
            try:
                apps = json.loads(script.text()).get("appsWarmupData", {})
            except ValueError:
                continue
            for app in apps.values() if isinstance(apps, dict) else ():
                for name, widget in app.items() if isinstance(app, dict) else ():
                    if name.startswith("widget") and isinstance(widget, dict):
                        events = widget.get("events", {})
                        for i, e in enumerate(events.get("events", []) if isinstance(events, dict) else []):
                            yield f"$.{name}.events[{i}]", e


def _look_headed(entry: Element) -> Iterator[Find]:
    for x in entry.children:
        if not isinstance(x, str) and x.tag in ("h1", "p"):
            yield x.tag, x.text(), *([a.text() for a in x.select("a")] if x.tag == "p" else ())


@lru_cache(_REMEMBERED)
def _headed_day(text: str, year: int) -> str | None:
    try:
        month, number = map(int, text.split()[1].split("."))
        return date(year, month, number).isoformat()
    except (IndexError, ValueError, OverflowError):
        return None


def _say_headed(finds: Iterable[Find], as_of: date) -> Iterator[Record]:
    """Headers like "MUSIC 7.12" set the day; each performer of a paragraph below is a record."""
    day = None
    for tag, text, *links in finds:
        if tag == "h1":
            day = _headed_day(text, as_of.year)
        elif day is not None:
            names = [n for a in links if (n := a.strip())]
            for line in map(str.strip, text.split("\n")):
                if line and not ("DOORS" in line or "SHOW" in line or "$" in line) and not any([n in line for n in names]):
                    names.append(line)
            for n in names:
                yield "entry-content", {"title": n, "event_day": day}


def _look_dated(page: Element) -> Iterator[Find]:
    for x in page.walk():
        if x.tag == "h2":
            yield "h2", x.text()
        elif x.tag == "article" and "EventItem" in x.classes:
            yield "", _raw(x, ".EventItem-body h3 a"), _raw(x, ".EventItem-body .u-h3 a"), _raw(x, ".EventItem-DateTime h5"), _raw(x, ".EventItem-description")


def _say_dated(finds: Iterable[Find], as_of: date) -> Iterator[Record]:
    """Items under the last h2, whose text is their day."""
    day = ""
    for tag, text, *more in finds:
        if tag:
            day = text
        elif (title := (text or "").strip()) and title != "Unknown Event":
            place, time, description = more
            yield "article.EventItem", {
                "title": title, "event_day": day, "event_time": (time or "").strip(), "location": "KEXP Studio" if place is None else place.strip(),
                "description": (description or "").strip(), "source": "kexp", "public": True,
            }


_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


@lru_cache(_REMEMBERED)
def _ticket_day(month: str, day: str, as_of: date, rolls: bool) -> str | None:
    if month.lower() in _MONTHS and day.isdigit():
        number = _MONTHS.index(month.lower()) + 1
        try:
            return date(as_of.year + (rolls and number < as_of.month and as_of.month >= 10), number, int(day)).isoformat()
        except (ValueError, OverflowError):
            pass
    return None


def _look_ticketed(page: Element) -> Iterator[Find]:
    for x in page.select("div.eventItem"):
        title, tickets, image = x.first("h3.title a"), x.first("a.tickets"), x.first(".thumb img")
        yield (
            None if title is None else title.text(), None if title is None else title.attrs.get("href"), _raw(x, "h4.tagline"), _raw(x, "div.promotion-text.tour"), _raw(x, "div.promotion-text"), _raw(x, "div.promotion-text:not(.tour)"),
            _raw(x, ".m-date__month"), _raw(x, ".m-date__day"), _raw(x, ".meta .time"), _raw(x, ".meta .age"), _raw(x, ".meta .location"),
            None if tickets is None else "onsalenow" in tickets.attrs.get("class", ""), None if tickets is None else tickets.attrs.get("href"), None if image is None else image.attrs.get("src"),
        )


def ticketed_items(source: str, venue: str, tours: bool) -> Listed:
    """Items of one kind of ticketing page. With tours, a tour name is told from the promoter, the venue is always the
    page's, and months before this one roll into the next year from October on."""

    def say(finds: Iterable[Find], as_of: date) -> Iterator[Record]:
        for title, link, line, tour, promoter, other, month, day, time, age, place, sale, tickets, image in finds:
            r: dict = {}
            if title is not None:
                r["title"] = title.strip()
                if link is not None:
                    r["detail_url"] = link
                    r["id"] = link.split("/")[-1]
            if line and (line := line.strip()):
                r["supporting_acts"] = line
            if tours and tour and (tour := tour.strip()):
                r["tour_name"] = tour
            by = other if tours else promoter
            if by is not None and ((by := by.strip()) or not tours):
                r["promoter"] = by
            month, day = (month or "").strip(), (day or "").strip()
            if at := _ticket_day(month, day, as_of, tours):
                r["event_day"] = at
                r["date_text"] = f"{month} {day}"
            if time is not None:
                r["time_text"] = time = time.strip()
                if ":" in time:
                    r["event_time"] = time.replace("Doors: ", "").replace("doors: ", "")
            if age is not None:
                r["age_restriction"] = age.strip()
            r["venue"] = venue if tours or place is None else place.strip()
            if sale is not None:
                if tickets is not None:
                    r["ticket_url"] = tickets
                r["tickets_on_sale"] = sale
            if image is not None:
                r["image_url"] = image
            r["public"], r["source"] = True, source
            if "title" in r or "event_day" in r:
                yield "div.eventItem", r

    return Listed(re.compile(r'<div[ \n][^<>]*[" \n]eventItem[" \n]'), _look_ticketed, say)


headed_paragraphs = Listed(re.compile("<h1[ \n>]"), _look_headed, _say_headed, "div.entry-content")
dated_articles = Listed(re.compile("<h2[ \n>]"), _look_dated, _say_dated)

# How sources name their plans.
PLANS: dict[str, Callable[[Element, date], Iterator[Record]]] = {
    "wix_warmup_v1": warmup_events, "darrells_html_v1": headed_paragraphs, "kexp_html_v1": dated_articles,
    "barboza_html_v1": ticketed_items("barboza", "The Barboza", False), "neumos_html_v1": ticketed_items("neumos", "Neumos", True),
}
PARSED = "source_id string, envelope_id string, payload_ref string, record_path string, record string"


def register(plan: str, extract: Callable[[Element, date], Iterator[Record]]) -> None:
    """Adds a page plan, or puts another in its place."""
    PLANS[plan] = extract


def parse_by_plan(pages: DataFrame, as_of: date) -> DataFrame:
    """pages (source_id, envelope_id, payload_ref, plan, html) -> PARSED rows, each page by its own plan in one pass."""
    plans = dict(PLANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, paths, records = [], [], []
            for i, (plan, html) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                for path, record in _records_of(html, plans[plan], as_of):
                    of.append(i)
                    paths.append(path)
                    records.append(record)
            at = pa.array(of, pa.int32())
            carried = [batch.column(i).take(at) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(paths, pa.string()), pa.array(records, pa.string())], names=["source_id", "envelope_id", "payload_ref", "record_path", "record"])

    return pages.select("source_id", "envelope_id", "payload_ref", "plan", "html").mapInArrow(run, PARSED)


def register_sql(spark: SparkSession) -> None:
    """parse_page(html, plan, as_of) in SQL, for LATERAL: records of a page as parse_by_plan has them. An unknown or missing plan gives
    nothing. It lists what page_records gives of a whole batch of pages; a table function in Python would get them one by one."""
    ship(spark)
    plans = dict(PLANS)

    def page_records(html: pa.Array, plan: pa.Array, as_of: pa.Array) -> pa.Array:
        ends, paths, records = [0], [], []
        for text, name, day in zip(html.to_pylist(), plan.to_pylist(), as_of.to_pylist(), strict=True):
            for path, record in _records_of(text, plans[name], day) if name in plans else ():
                paths.append(path)
                records.append(record)
            ends.append(len(paths))
        rows = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(records, pa.string())], names=["record_path", "record"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    spark.udf.register("page_records", F.arrow_udf(page_records, "array<struct<record_path string, record string>>"))
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION parse_page(html STRING, plan STRING, as_of DATE) RETURNS TABLE (record_path STRING, record STRING) "
        "RETURN SELECT record_path, record FROM inline(page_records(html, plan, as_of))"
    )


_JSON = json.JSONEncoder(ensure_ascii=False).encode


def _records_of(html: str | None, plan: Callable[[Element, date], Iterator[Record]], as_of: date) -> list[tuple[str, str]]:
    finds = plan.finds(html or "") if isinstance(plan, Listed) else None
    found = list(plan(tree(html or ""), as_of) if finds is None else plan.say(finds, as_of)) or [("html", {"html_len": len((html or "").encode())})]
    return [(path, _JSON(record)) for path, record in found]


def parse_pages(pages: DataFrame, plan: str, as_of: date) -> DataFrame:
    """pages (source_id, envelope_id, payload_ref, html) -> PARSED rows by one plan."""
    return parse_by_plan(pages.withColumn("plan", F.lit(plan)), as_of)


def find_events(value: object) -> list[dict]:
    """Objects in arrays under keys that speak of events or items, which have a title, name, scheduling or startDate: at any
    depth, in the order of the document."""
    out: list[dict] = []
    left: list[tuple[str | None, object]] = [(None, value)]
    while left:
        key, v = left.pop()
        if isinstance(v, list) and key is not None and ("event" in key.lower() or "item" in key.lower()):
            out += [x for x in v if isinstance(x, dict) and x.keys() & {"title", "name", "scheduling", "startDate"}]
        elif isinstance(v, dict):
            left += reversed(list(v.items()))
        elif isinstance(v, list):
            left += [(None, x) for x in reversed(v)]
    return out


def events_in(records: DataFrame) -> DataFrame:
    """Every event-like object anywhere in JSON documents (source_id, envelope_id, payload_ref, payload), as PARSED rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for source, envelope, ref, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                try:
                    found = find_events(json.loads(payload or "null"))
                except (ValueError, RecursionError):  # no JSON, or nested deeper than the parser goes
                    found = []
                for i, e in enumerate(found):
                    for column, value in zip(rows, (source, envelope, ref, f"$..[{i}]", json.dumps(e, ensure_ascii=False)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in rows], names=["source_id", "envelope_id", "payload_ref", "record_path", "record"])

    return records.select("source_id", "envelope_id", "payload_ref", "payload").mapInArrow(run, PARSED)
