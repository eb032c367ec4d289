"""Raw field texts of HTML pages, read inside Spark tasks.

This is the only part that needs Python: finding the nodes of a page. What a field means (dates,
ids, links, fallbacks) is worked out afterwards with Spark columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from html import unescape
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
# An opening tag ends these open ones without an end tag of their own.
_ENDS = {
    **{tag: frozenset({"p"}) for tag in _BLOCK},
    "a": frozenset({"a"}),
    "button": frozenset({"button", "p"}),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    **{tag: frozenset({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup", "p"}) for tag in ("tbody", "thead", "tfoot")},
    "tr": frozenset({"tr", "td", "th", "caption", "colgroup", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
    "optgroup": frozenset({"option", "optgroup"}),
}
# Text markup: below it a link still ends the link that it stands in.
_INLINE = frozenset("b big code em font i s small span strike strong tt u".split())


# Markup that is no text: comments, declarations, end tags and start tags. A quoted value may hold ``>``,
# and everything up to the end tag of a script or style is its text.
# No part can be given back once matched, so reading takes linear time on any input.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?)*+"""
_MARKUP = re.compile(
    rf"""(<!--.*?(?:-->|\Z) | <[!?][^>]*+(?:>|\Z) | </[a-zA-Z][^>]*+(?:>|\Z)
      | <(?i:script)(?=[\s/>]){_ATTRIBUTES}>.*?(?=(?i:</script)|\Z)
      | <(?i:style)(?=[\s/>]){_ATTRIBUTES}>.*?(?=(?i:</style)|\Z)
      | <[a-zA-Z][^\s/>]*+{_ATTRIBUTES}(?:>|\Z))""",
    re.DOTALL | re.VERBOSE,
)
# One piece of such markup. Groups: slash of an end tag, name, attributes, whether it is complete, what follows it.
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(>?)(.*)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
# A slash that ends a tag, and not an unquoted value.
_CLOSED = re.compile(r"""(?:^|[\s"'])/$|(?:^|\s)[^\s=]+/$""")
# Tags that a reader keeps, and the longest that it keeps.
_KEPT, _KEPT_LENGTH = 4096, 256


class Tag:
    """A start tag, an end tag (``ended``) or other markup (no name) as it is written."""

    __slots__ = ("name", "ended", "raw", "ends", "inline", "empty", "text", "fits", "_attrs")

    def __init__(self, piece: str):
        self.name = self.ended = self.raw = self.text = ""
        self.fits: tuple[int, ...] = ()
        self.ends: frozenset[str] | None = None
        self.inline = self.empty = False
        self._attrs: dict[str, str] | None = None
        found = _TAG.match(piece)
        if not found:
            return
        slash, name, attrs, done, text = found.groups()
        name = name.lower()
        if slash:
            self.ended = name
        elif done:
            self.name, self.raw, self.text = name, attrs, text
            self.ends, self.inline = _ENDS.get(name), name in _INLINE
            raw_text = name == "script" or name == "style"
            self.empty = name in _VOID or (not raw_text and attrs.endswith("/") and _CLOSED.search(attrs) is not None)

    @property
    def attrs(self) -> dict[str, str]:
        """Attributes, parsed when first asked for; the first of equal names counts."""
        if self._attrs is None:
            pairs = _ATTRIBUTE.findall(self.raw)
            self._attrs = {name.lower(): unescape(a or b or c) for name, a, b, c in reversed(pairs)}
        return self._attrs

    def fits_step(self, step: Step) -> bool:
        return (not step.tag or step.tag == self.name) and (not step.attr or step.fits(self.attrs))


class Tags:
    """Tags as they were read, with the numbers of the steps that each fits.

    Pages of a board write the same tags again and again; what was read is forgotten once there is much of it.
    """

    def __init__(self, steps: Sequence[Step] = ()):
        self.steps = list(dict.fromkeys(steps))
        self.known: dict[str, Tag] = {}
        numbered = [(n, step, step.equals or step.holds or "") for n, step in enumerate(self.steps)]
        self._any = [x for x in numbered if not x[1].tag]
        self._of = {step.tag: [x for x in numbered if x[1].tag in ("", step.tag)] for step in self.steps}

    def learn(self, piece: str) -> Tag:
        tag = Tag(piece)
        if tag.name:
            # Most steps are ruled out before the attributes are parsed.
            raw = tag.raw
            referring = "&" in raw
            tag.fits = tuple(
                [n for n, step, sought in self._of.get(tag.name, self._any) if (referring or sought in raw) and tag.fits_step(step)]
            )
        if len(piece) <= _KEPT_LENGTH and not tag.text:
            if len(self.known) >= _KEPT:
                self.known.clear()
            self.known[piece] = tag
        return tag


class Page:
    """A page as flat lists in document order: the nodes below node ``i`` are ``i+1 .. end[i]-1``."""

    def __init__(self, html: str, known: Tags | None = None):
        known = known or Tags()
        kept, learn = known.known, known.learn
        pieces = _MARKUP.split(html)
        room = len(pieces) // 2 + 1
        nodes, parent, end = [Tag("")], [-1], [0] * room
        texts, text_from, text_to = [], [0], [0] * room
        # Per step the nodes that fit it, per node the innermost around it that is no text markup.
        fitting: list[list[int]] = [[] for _ in known.steps]
        block = [0]
        # The innermost open element, and how many of a tag are open.
        here, open_tags = 0, defaultdict(int)
        if first := unescape(pieces[0]):
            texts.append(first)
        for piece, text in zip(pieces[1::2], pieces[2::2]):
            tag = kept.get(piece) or learn(piece)
            stop = here
            if name := tag.name:
                if ends := tag.ends:
                    if name == "a" and nodes[block[here]].name == "a":
                        stop = block[here]
                    while nodes[stop].name in ends:
                        stop = parent[stop]
            elif open_tags[tag.ended]:
                while nodes[stop].name != tag.ended:
                    stop = parent[stop]
                stop = parent[stop]
            # Every element that is passed on the way is ended too, so the way is paid for once.
            while here != stop:
                end[here], text_to[here] = len(nodes), len(texts)
                open_tags[nodes[here].name] -= 1
                here = parent[here]
            if name:
                node = len(nodes)
                nodes.append(tag)
                parent.append(here)
                text_from.append(len(texts))
                for number in tag.fits:
                    fitting[number].append(node)
                block.append(block[here] if tag.inline else node)
                if tag.empty:
                    end[node], text_to[node] = node + 1, len(texts)
                else:
                    open_tags[name] += 1
                    here = node
                    if tag.text:
                        texts.append(tag.text)
            if text and ("&" not in text or (text := unescape(text))):
                texts.append(text)
        while here >= 0:
            end[here], text_to[here] = len(nodes), len(texts)
            here = parent[here]
        self.nodes, self.parent, self.end = nodes, parent, end
        self.texts, self.text_from, self.text_to = texts, text_from, text_to
        self.steps, self.fitting = known.steps, fitting

    @property
    def tags(self) -> list[str]:
        return [tag.name for tag in self.nodes]

    @property
    def by_tag(self) -> dict[str, list[int]]:
        found: dict[str, list[int]] = {}
        for node, tag in enumerate(self.nodes):
            if node:
                found.setdefault(tag.name, []).append(node)
        return found

    def attrs(self, node: int) -> dict[str, str]:
        return self.nodes[node].attrs

    def matching(self, step: Step) -> list[int]:
        """All nodes of the page that fit the step."""
        if step in self.steps:
            return self.fitting[self.steps.index(step)]
        return [n for n in range(1, len(self.nodes)) if self.nodes[n].fits_step(step)]

    def move(self, found: list[int], step: Step, fitting: list[int]) -> list[int]:
        """The nodes of ``fitting`` that one step leads to, in document order."""
        if not fitting or not found:
            return []
        end, parent, slices = self.end, self.parent, []
        for node in found:
            first = bisect_left(fitting, node if step.or_self else node + 1)
            inside = fitting[first : bisect_left(fitting, end[node], first)]
            if step.child:
                inside = [n for n in inside if parent[n] == node]
            if len(found) == 1:
                return inside
            slices.append(inside)
        # Start nodes may lie inside each other.
        return sorted({n for part in slices for n in part})

    def reach(self, starts: list[int], steps: tuple[Step, ...]) -> list[int]:
        """The nodes that the steps lead to, in document order."""
        found = starts
        for step in steps:
            found = self.move(found, step, self.matching(step))
        return found

    def read(self, starts: list[int], field: Field) -> list[str]:
        """The texts of a field below the start nodes."""
        return self.texts_of(self.reach(starts, field.steps), field)

    def own_texts(self, node: int) -> list[str]:
        """The text pieces of a node that stand in no node below it."""
        found, begin, inner = [], self.text_from[node], node + 1
        while inner < self.end[node]:
            found += self.texts[begin : self.text_from[inner]]
            begin, inner = self.text_to[inner], self.end[inner]
        return found + self.texts[begin : self.text_to[node]]

    def texts_of(self, nodes: list[int], field: Field) -> list[str]:
        """The texts of a field at the nodes that its steps lead to."""
        out: list[str] = []
        read = field.read
        for node in nodes:
            if read == "string":
                out.append("".join(self.texts[self.text_from[node] : self.text_to[node]]))
            elif read == "text":
                out.extend(self.own_texts(node))
            elif read.startswith("..@"):
                out.append(self.attrs(self.parent[node]).get(read[3:], ""))
            else:
                value = self.nodes[node].attrs.get(read[1:])
                if value is not None:
                    out.append(value)
            if out and field.only_first:
                return out[:1]
        return out


class Step(NamedTuple):
    """One move through a page: to children, or to all nodes below; the attribute is equal to or holds a value."""

    tag: str = ""
    attr: str = ""
    equals: str | None = None
    holds: str | None = None
    child: bool = False
    or_self: bool = False

    def fits(self, attrs: dict[str, str]) -> bool:
        value = attrs.get(self.attr)
        if value is None:
            return False
        return value == self.equals if self.equals is not None else (self.holds or "") in value


class Field(NamedTuple):
    """Texts to read from the nodes that ``steps`` reach.

    ``read``: ``string`` (all text below a node), ``text`` (its own text pieces), an attribute as
    ``@name``, or an attribute of the parent as ``..@name``.
    """

    steps: tuple[Step, ...]
    read: str = "string"
    only_first: bool = True


class Board(NamedTuple):
    """Where the records of a board are on a page, and the fields of a record and of the whole page."""

    records: tuple[tuple[Step, ...], ...]
    fields: dict[str, Field]
    page_fields: dict[str, Field] = {}


class _Ways:
    """Fields read from one start node; a step that several of them begin with is taken once."""

    def __init__(self, ways: Sequence[tuple[Step, ...]], known: Tags):
        numbers = {step: number for number, step in enumerate(known.steps)}
        places: dict[tuple[int, Step], int] = {}
        # Per move the place that it starts from, the step and the step's number; place 0 is the start.
        self.moves: list[tuple[int, Step, int]] = []
        self.ends: list[int] = []
        for steps in ways:
            at = 0
            for step in steps:
                if (at, step) not in places:
                    self.moves.append((at, step, numbers[step]))
                    places[at, step] = len(self.moves)
                at = places[at, step]
            self.ends.append(at)

    def walk(self, page: Page, start: int) -> list[list[int]]:
        """The nodes at the end of every way."""
        found, fitting, move = [[start]], page.fitting, page.move
        for at, step, number in self.moves:
            found.append(move(found[at], step, fitting[number]) if fitting[number] and found[at] else [])
        return [found[place] for place in self.ends]


class Reader:
    """Reads the records of pages by a board's rules."""

    def __init__(self, board: Board):
        self.fields = {name: field for name, field in board.page_fields.items() if name not in board.fields} | board.fields
        shared = [field for name, field in board.page_fields.items() if name not in board.fields]
        ways = [*board.records, *(f.steps for f in shared), *(f.steps for f in board.fields.values())]
        self._tags = Tags([step for steps in ways for step in steps])
        self._shared, self._own = shared, list(board.fields.values())
        self._records = _Ways(board.records, self._tags)
        self._shared_ways, self._own_ways = (_Ways([f.steps for f in fields], self._tags) for fields in (shared, self._own))

    def read(self, html: str | None) -> list[list[list[str]]]:
        """The texts of every field, in the order of ``fields``, per record in the order of the record rules and of the page."""
        page = Page(html or "", self._tags)
        nodes = [n for found in self._records.walk(page, 0) for n in found]
        shared = [page.texts_of(*x) for x in zip(self._shared_ways.walk(page, 0), self._shared)] if nodes else []
        return [[*shared, *(page.texts_of(*x) for x in zip(self._own_ways.walk(page, n), self._own))] for n in nodes]


def read_page(html: str | None, board: Board) -> list[dict[str, list[str]]]:
    """One dict of field texts per record, in the order of the record rules and of the page."""
    reader = Reader(board)
    return [dict(zip(reader.fields, texts)) for texts in reader.read(html)]


def _markers(board: Board) -> list[str] | None:
    """Texts of which one stands on every page with a record, unless it is written with character references."""
    found = [next((step.equals or step.holds for step in rule if step.equals or step.holds), None) for rule in board.records]
    return found if all(found) else None


def raw_records_of(pages: DataFrame, boards: dict[str, Board], page_id: str = "page_id", at_once: int = 4000) -> DataFrame:
    """(site, page_id, url, pos) and a column per field of every record on every page (site, page_id, url, html).

    A page is read by its own board's rules, in one pass over all pages; fields that its board does not have are
    NULL. A field that reads only its first text is a string, NULL when there is none; others are arrays. Fields of
    one name must be of one kind in all boards.
    """
    key = pages.schema[page_id]
    fields: dict[str, Field] = {}
    for board in boards.values():
        for name, field in {**board.page_fields, **board.fields}.items():
            if fields.setdefault(name, field).only_first != field.only_first:
                raise ValueError(f"field {name} is a text on one board and a list on another")
    schema = StructType([StructField("site", StringType()), StructField("page_id", key.dataType), StructField("url", StringType()), StructField("pos", IntegerType())])
    for name, field in fields.items():
        schema.add(name, StringType() if field.only_first else ArrayType(StringType()))
    arrow_schema = to_arrow_schema(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [[r[i] for r in rows] for i in range(4)]
        for texts, field in zip(zip(*(r[4] for r in rows)), fields.values()):
            columns.append([t[0] if t else None for t in texts] if field.only_first else texts)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema)], schema=arrow_schema)

    markers = {site: [*found, "&"] for site, board in boards.items() if (found := _markers(board))}

    def marked(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows of a batch without those of pages that hold no record's marker."""
        site, html = batch.column(0), batch.column(3)
        wanted = pc.is_in(site, pa.array([name for name in boards if name not in markers], site.type))
        for name, held in markers.items():
            holds = reduce(pc.or_, [pc.fill_null(pc.match_substring(html, m), False) for m in held])
            wanted = pc.or_(wanted, pc.and_(pc.equal(site, name), holds))
        return batch.filter(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = {site: Reader(board) for site, board in boards.items()}
        # Per board the place of every column among its own fields.
        places = {site: [{name: i for i, name in enumerate(r.fields)}.get(name) for name in fields] for site, r in readers.items()}
        for batch in batches:
            batch, rows = marked(batch), []
            for site, number, url, html in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for pos, texts in enumerate(readers[site].read(html)):
                    rows.append((site, number, url, pos, [None if i is None else texts[i] for i in places[site]]))
                if len(rows) >= at_once:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    # No filter by markers here: it would move in front of the step that spreads the pages over the tasks, and
    # make their text there, once per marker.
    return pages.select("site", page_id, "url", "html").mapInArrow(read, schema)


def raw_records(pages: DataFrame, board: Board, page_id: str = "page_id", at_once: int = 4000) -> DataFrame:
    """(page_id, url, pos) and a column per field of every record on every page of one board."""
    named = pages.select(F.lit("").alias("site"), page_id, "url", "html")
    return raw_records_of(named, {"": board}, page_id, at_once).drop("site")
