"""License scans: exact short phrases, and fuzzy search for short notices.

*Fuzzy search.* A notice of words may stand in a text with up to ``errors`` edited characters. It is cut into
``errors + 1`` pieces; by the pigeonhole principle a place with no more edits holds at least one piece
unchanged. Pieces are found by plain substring search in the text's words joined by single spaces; around each
the ``regex`` library's bounded-error matching (``{e<=k}``, best match) verifies the edits and gives the span.

*Scale.* One pass without a shuffle; the notices are a small fixed table that travels with the function.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache
from itertools import accumulate

from pyspark.sql import DataFrame

from sensorflow.llm.common import WORD_BYTES, id_type, map_texts, pick

#: Phrases whose words stand consecutively, and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices (lower case, words and single spaces), their labels, and the edits allowed.
NOTICES = (
    ("licensed under the gnu general public license", "gpl", 4),
    ("gnu general public licence version", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 7),
    ("mozilla public license version 2 0", "mpl", 3),
    ("licensed under a creative commons attribution", "cc-by", 4),
    ("creative commons attribution sharealike", "cc-by-sa", 3),
    ("licensed under cc by nc", "cc-by-nc", 1),
    ("licensed under cc by sa", "cc-by-sa", 1),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 6),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
)


def pieces(notice: str, errors: int) -> list[tuple[int, bytes]]:
    """``errors + 1`` pieces of nearly equal length, each with its place in the notice."""
    n = errors + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b].encode()) for a, b in zip(cuts, cuts[1:])]


@cache
def _compiled(notices: tuple) -> list:
    """Per notice: its text, label, errors, pieces and fuzzy pattern (whole words only)."""
    import regex
    return [(n, label, e, pieces(n, e), regex.compile(rb"(?b)(?<= )(?:%s){e<=%d}(?= )" % (n.encode(), e)))
            for n, label, e in notices]


def fuzzy_spans(joined: bytes, notices: tuple = NOTICES) -> list[tuple[int, int, str, int]]:
    """``(start, end, label, edits)`` of notices in words joined (and framed) by single spaces.

    Each seed's own window, too small for two notices, is searched for its best match. Of matches of one notice
    that overlap, the one of fewest edits stays (then the first).
    """
    out = []
    for notice, label, errors, parts, pattern in _compiled(notices):
        places = set()
        for offset, piece in parts:
            at = joined.find(piece)
            while at >= 0:
                places.add(at - offset)
                at = joined.find(piece, at + 1)
        reach, size = errors + 1, len(notice)
        found = set()
        for p in places:
            m = pattern.search(joined, max(0, p - reach), min(len(joined), p + size + reach))
            if m:
                found.add((sum(m.fuzzy_counts), m.start(), m.end()))
        wide = size + errors  # no match is longer, so one that overlaps another lies in its or a neighbouring cell
        taken: dict[int, list[tuple[int, int]]] = {}
        for edits, a, z in sorted(found):
            near = (x for cell in (a // wide - 1, a // wide, a // wide + 1) for x in taken.get(cell, ()))
            if all(z <= start or stop <= a for start, stop in near):
                taken.setdefault(a // wide, []).append((a, z))
                out.append((a, z, label, edits))
    return out


def scan(text: str | None, phrases: dict[str, str] = PHRASES, notices: tuple = NOTICES) -> dict:
    """All finds in one text; word places count from 0, spans are (first word, last word + 1, label, edits)."""
    words = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []
    joined = b" " + b" ".join(words) + b" "
    base, labels = [], set()
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = joined.find(wanted)
        while at >= 0:
            base.append(at + 1)
            labels.add(label)
            at = joined.find(wanted, at + 1)
    fuzzy = fuzzy_spans(joined, notices)
    starts = list(accumulate((len(w) + 1 for w in words), initial=1)) if base or fuzzy else []  # of every word, and past the last

    def word(place: int) -> int:
        return bisect_left(starts, place)
    base = [word(at) for at in base]
    fuzzy = [(word(a), word(z + 1), label, e, z - a) for a, z, label, e in fuzzy]
    best = max([1.0 - e / size for *_, e, size in fuzzy], default=0.0)
    return {"n_words": len(words), "n_base": len(base), "first_word": min(base, default=None), "last_word": max(base, default=None),
            "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {x[2] for x in fuzzy})),
            "score": 1.0 if base else max(0.0, min(1.0, best)),
            "spans": [{"first": a, "stop": z, "label": label, "edits": e} for a, z, label, e, _ in sorted(fuzzy)]}


_FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
           "score double, spans array<struct<first:bigint,stop:bigint,label:string,edits:int>>")


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
                 notices: tuple = NOTICES) -> DataFrame:
    """``id`` and the finds of each text, one row per row of ``df``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` come from the exact phrases, ``spans`` from
    the fuzzy notices, ``labels`` from both. ``score`` is 1 with an exact phrase, else 1 - edits / length of
    the best notice, 0 without any. Null and empty texts have no words and no finds. Repeated rows keep a row
    each; an empty table gives an empty result; extra columns are ignored. Texts are scanned whole, one at a
    time, in time linear in their length and finds (a find's word is looked up by bisection).
    """
    docs = pick(df, id=id_col, text=text_col)
    names = re.findall(r"(?:^|, )(\w+) ", _FIELDS)

    def step(batch: dict) -> dict:
        found = [scan(t, phrases, notices) for t in batch["text"]]
        return {"id": batch["id"]} | {n: [f[n] for f in found] for n in names}
    return map_texts(docs, step, f"id {id_type(docs)}, {_FIELDS}")
