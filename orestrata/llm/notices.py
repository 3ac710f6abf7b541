"""License notices in whole texts, also where they were altered a little.

A text is lower-cased (A-Z), cut into words at every ASCII character but letters and digits, and its
words are joined by single spaces. Notices are stated in that form. A notice which may hold k
edits (of single characters, ``edits_allowed``) is split into k + 1 pieces: one of them is intact in any such
occurrence, so an Aho-Corasick scan for the pieces finds every place where one can be. There the
regex library's bounded-error matching looks for the fewest edits within the piece's reach, and the
span is kept if the notice's core words occur in it unaltered: they tell notices apart that
differ by few letters. Spans of one notice do not overlap; the leftmost comes first.

Each text is searched on its own, as a whole, in one narrow pass; nothing is exchanged.

Phrases are found exactly, at every place where their words stand consecutively, and give labels of
their own. ``labels`` are those of phrases and of notices. ``score`` is 1 with a phrase, else one less
the share of edited letters of the best span, else 0.

A null text is an empty one: no words, no labels, score 0. Every row gives one row, in whatever number it is
repeated; a null id is carried. Columns other than doc_id and text are not looked at. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, partial

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Letters of a notice for each edit it may hold, and the most edits of any.
LETTERS_PER_EDIT = 12
MOST_EDITS = 3

_PLAIN = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,notice:string,start:long,end:long,first_word:long,n_words:long,edits:int>>"
)


@dataclass(frozen=True)
class Notice:
    """A short notice in plain form; ``core`` are words which must occur unaltered."""

    label: str
    text: str
    core: str = ""

    @property
    def edits_allowed(self) -> int:
        return min(MOST_EDITS, len(self.text) // LETTERS_PER_EDIT)

    @property
    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): one more than edits allowed, of nearly equal lengths."""
        parts, size = self.edits_allowed + 1, len(self.text)
        bounds = [size * k // parts for k in range(parts + 1)]
        return [(a, self.text[a:b]) for a, b in zip(bounds, bounds[1:])]

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(f"(?:{regex.escape(self.text)}){{e<={self.edits_allowed}}}", regex.BESTMATCH)


# Phrases with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Opening words of public license notices.
NOTICES = (
    Notice("agpl", "gnu affero general public license", "affero"),
    Notice("apache", "licensed under the apache license", "apache"),
    Notice("apache", "apache license version 2 0", "apache"),
    Notice("boost", "boost software license", "boost"),
    Notice("bsd", "redistribution and use in source and binary forms", ""),
    Notice("bsd", "under the bsd license", "bsd"),
    Notice("cc-by", "creative commons attribution", "commons"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", "commons"),
    Notice("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Notice("cc-by-sa", "creative commons attribution sharealike", "commons"),
    Notice("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Notice("cc0", "dedicated to the public domain under cc0", "cc0"),
    Notice("epl", "eclipse public license", "eclipse"),
    Notice("gpl", "gnu general public license", "gnu"),
    Notice("gpl", "this program is free software you can redistribute it", ""),
    Notice("isc", "permission to use copy modify and or distribute this software", ""),
    Notice("lgpl", "gnu lesser general public license", "lesser"),
    Notice("mit", "permission is hereby granted free of charge to any person", ""),
    Notice("mit", "released under the mit license", "mit"),
    Notice("mit", "under the mit license", "mit"),
    Notice("mpl", "mozilla public license", "mozilla"),
    Notice("unlicense", "this is free and unencumbered software", ""),
)


def plain_words(text: str) -> bytes:
    """The text's words in UTF-8, joined by single spaces."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(_PLAIN).split())


def places(plain: bytes, phrase: str) -> list[int]:
    """Numbers of the words at which the phrase's words stand consecutively."""
    padded, wanted = b" " + plain + b" ", b" " + phrase.encode() + b" "
    found, at, words, counted = [], padded.find(wanted), 0, 0
    while at >= 0:
        words += padded.count(b" ", counted, at)
        counted = at
        found.append(words)
        at = padded.find(wanted, at + 1)
    return found


class Finder:
    """Finds altered notices in plain texts."""

    def __init__(self, notices: Sequence[Notice]):
        self.notices = [each for each in notices if each.text]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for offset, piece in notice.pieces:
                seeds.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if seeds:
            self.automaton.make_automaton()

    def spans(self, plain: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in the plain text, by notice and start."""
        if not self.notices:
            return []
        hits: dict[int, list[tuple[int, int]]] = {}
        for last, (size, uses) in self.automaton.iter(plain):
            for number, offset in uses:
                hits.setdefault(number, []).append((last + 1 - size, offset))
        found = []
        for number in sorted(hits):
            notice, free = self.notices[number], 0
            reach = notice.edits_allowed
            for at, offset in sorted(hits[number], key=lambda hit: (hit[0] - hit[1], hit)):
                if at < free:
                    continue
                first = max(free, at - offset - reach)
                match = notice.pattern.search(plain, first, at - offset + len(notice.text) + reach)
                if match and self._core_intact(notice, plain, *match.span()):
                    found.append((number, *match.span(), sum(match.fuzzy_counts)))
                    free = match.end()
        return found

    @staticmethod
    def _core_intact(notice: Notice, plain: str, start: int, end: int) -> bool:
        """Whether the core stands in the span as whole words."""
        if not notice.core:
            return True
        return f" {notice.core} " in f"{' ' if start == 0 else plain[start - 1]}{plain[start:end]}{plain[end : end + 1] or ' '}"


def _scanned(text: str, finder: Finder, phrases: Sequence[tuple[str, str]]) -> tuple:
    plain = plain_words(text)
    base, starts = set(), []
    for phrase, label in phrases:
        at = places(plain, phrase)
        starts += at
        base |= {label} if at else set()
    decoded = plain.decode("utf-8", "surrogatepass")
    spans, score, labels = [], float(bool(starts)), set(base)
    found = finder.spans(decoded)
    if found:
        words = [match.span() for match in _WORD.finditer(text)]
        for number, start, end, edits in found:
            notice = finder.notices[number]
            first = decoded.count(" ", 0, start + (decoded[start] == " "))
            last = decoded.count(" ", 0, end - (decoded[end - 1] == " "))
            labels.add(notice.label)
            score = max(score, 1 - edits / len(notice.text))
            spans.append((notice.label, notice.text, words[first][0], words[last][1], first, last - first + 1, edits))
    return (
        plain.count(b" ") + 1 if plain else 0,
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
        spans,
    )


_KINDS = (
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
    pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                        ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32())])),
)
_NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def _scan(
    batches: Iterator[pa.RecordBatch], notices: Sequence[Notice], phrases: Sequence[tuple[str, str]]
) -> Iterator[pa.RecordBatch]:
    finder = Finder(notices)
    fields = [field.name for field in _KINDS[-1].value_type]
    for batch in batches:
        rows = [_scanned(text.as_py() or "", finder, phrases) for text in batch.column("text")]
        columns = [list(x) for x in zip(*rows)] or [[] for _ in _KINDS]
        columns[-1] = [[dict(zip(fields, span)) for span in spans] for spans in columns[-1]]
        arrays = [pa.array(x, kind) for x, kind in zip(columns, _KINDS)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *_NAMES])


def scan(
    docs: DataFrame, notices: Sequence[Notice] = NOTICES, phrases: Sequence[tuple[str, str]] = PHRASES
) -> DataFrame:
    """Per document: its number of words, phrases, labels, score, and the spans of notices in its text.

    ``start`` and ``end`` of a span count characters of the text as given, ``first_word`` counts words from 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    search = partial(_scan, notices=tuple(notices), phrases=tuple(phrases))
    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id {kind}, {RESULT}")
