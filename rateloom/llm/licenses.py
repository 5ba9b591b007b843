"""License notices, also with typing errors.

Exact phrases are counted by words. Fuzzy search: a notice that may hold k character errors is split into k + 1 pieces, of
which at least one stands in the text unharmed (the pigeonhole principle). One automaton finds all pieces of all notices in
a single pass over the text; around each found piece the regex library looks for the whole notice with at most k errors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import map_batches

#: Exact phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices: label, words as they are normalised, and how many character errors (inserted, dropped, changed) may occur.
NOTICES = (
    ("mit", "under the mit license", 2),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 5),
    ("apache", "apache license", 1),
    ("apache", "licensed under the apache license version 2 0", 3),
    ("gpl", "general public license", 2),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms", 6),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 6),
    ("mpl", "mozilla public license", 2),
    ("cc", "licensed under cc by", 1),
    ("cc-by-nc", "licensed under cc by nc", 1),
    ("cc", "creative commons attribution", 2),
    ("unlicense", "this is free and unencumbered software released into the public domain", 5),
)
_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, spans array<struct<label:string,notice:int,start:long,end:long,errors:int>>")
#: Lower case for A-Z; every other ASCII character that is no digit or letter becomes a space.
_NORMAL = bytes(b if b >= 128 or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 32 for b in range(256))


def normalise(text: str | None) -> str:
    """The text's words, joined by single spaces."""
    return b" ".join((text or "").encode("utf-8", "replace").translate(_NORMAL).split()).decode("utf-8", "replace")


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces with their offsets."""
    cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class NoticeSearch:
    def __init__(self, notices=NOTICES):
        import ahocorasick
        import regex

        self.notices = notices
        self.seeds = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, (_, notice, errors) in enumerate(notices):
            for offset, piece in pieces(notice, errors):
                owners.setdefault(piece, []).append((k, offset))
        for piece, who in owners.items():
            self.seeds.add_word(piece, (len(piece), who))
        self.seeds.make_automaton()
        self.exact = [regex.compile(rf"(?e)(?<!\S)(?:{regex.escape(n)}){{e<={e}}}(?!\S)") for _, n, e in notices]

    def windows(self, words: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice the stretches of the text, cut at words, in which it may stand."""
        found: dict[int, list[tuple[int, int]]] = {}
        for last, (length, who) in self.seeds.iter(words):
            for k, offset in who:
                _, notice, errors = self.notices[k]
                start = last - length + 1 - offset - errors
                found.setdefault(k, []).append((max(0, start), start + len(notice) + 2 * errors))
        merged: dict[int, list[tuple[int, int]]] = {}
        for k, spans in found.items():
            out: list[list[int]] = []
            for a, b in sorted(spans):
                a = words.rfind(" ", 0, a + 1) + 1
                b = len(words) if (c := words.find(" ", b)) < 0 else c
                if out and a <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], b)
                else:
                    out.append([a, b])
            merged[k] = [(a, b) for a, b in out]
        return merged

    def search(self, words: str) -> list[tuple[int, int, int, int]]:
        """(notice, first character, end, errors), by place."""
        hits = []
        for k, spans in self.windows(words).items():
            for a, b in spans:
                for m in self.exact[k].finditer(words[a:b]):
                    hits.append((k, a + m.start(), a + m.end(), sum(m.fuzzy_counts)))
        return sorted(hits, key=lambda h: (h[1], h[0]))


@cache
def notice_search(notices=NOTICES) -> NoticeSearch:
    return NoticeSearch(notices)


def places(words: str, phrase: str) -> list[int]:
    """Starts, in words, of every place where the phrase's words stand consecutively."""
    out, padded, at, counted, word = [], f" {words} ", 0, 0, 0
    needle = f" {phrase} "
    while (at := padded.find(needle, at)) >= 0:
        word += padded.count(" ", counted, at)
        counted = at
        out.append(word)
        at += 1
    return out


def scan_licenses(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases: dict[str, str] | None = None,
                  notices=NOTICES) -> DataFrame:
    """Per row, over the whole text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Missing and empty texts have no words: counts 0, places null, labels empty, score 0. Repeated rows give repeated rows.
    ``spans`` are the fuzzy hits: label, number of the notice, first word and word behind the last, errors. ``score`` is 1
    for an exact phrase, else the best hit's share of unharmed characters, 0 without one.
    """
    wanted = dict(PHRASES if phrases is None else phrases)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = notice_search(notices)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = normalise(text)
                found = {p: at for p in wanted if (at := places(words, p))}
                starts = [x for at in found.values() for x in at]
                hits = search.search(words)
                spans, counted, word = [], 0, 0
                for k, a, b, errors in hits:
                    word += words.count(" ", counted, a)
                    counted = a
                    spans.append({"label": notices[k][0], "notice": k, "start": word,
                                  "end": word + words.count(" ", a, b) + 1, "errors": errors})
                base = {wanted[p] for p in found}
                score = max([1.0 if base else 0.0, *(max(0.0, 1 - s["errors"] / len(notices[s["notice"]][1])) for s in spans)])
                rows.append({
                    "doc_id": doc_id, "n_words": words.count(" ") + 1 if words else 0, "n_base": len(starts),
                    "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {s["label"] for s in spans})),
                    "score": score, "spans": spans})
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return map_batches(rows, scan, _SCHEMA)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("notice", pa.int32()), ("start", pa.int64()),
                                  ("end", pa.int64()), ("errors", pa.int32())])))])
