"""License scan by ordered signature rules.

Texts are reduced to lower-case words joined by single spaces. A rule's pattern is tried only
where its keyword occurs, and keywords only where one of a few gate words does. Detections
are resolved in order of priority, then length, then place: one that lies inside an interval
already accepted is suppressed, and so is one that overlaps an accepted one of higher
priority. The score is 1 - product of (1 - confidence) over the accepted detections' labels.

Base phrases are counted wherever their words stand one after the other, whether or not a
longer detection covers them, and their labels always stay. The work of a text is linear in its
length and, but for sorting, in its detections.

Null texts are empty: no words, null first and last word, no labels (empty strings), score 0.
Rows that repeat get equal results. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwarden.llm.common import column_batches
from clickwarden.llm.license_rules import Rule, build_rules

BASE = {b"gnu general public license": "gpl", b"apache license": "apache", b"cc by": "cc-by", b"mit license": "mit"}
# every keyword's rules need one of these in the text
GATES = (b"licen", b"spdx", b"cc ", b"cc0", b"creative", b"public domain", b"permi", b"rights reserved", b"confidential",
         b"furnished", b"redistribution", b"endorse", b"advertising", b"free software", b"the unlicense", b"bsd",
         b"no attribution", b"express or implied", b"perl itself", b"affero", b"boost", b"cc by")
_SPACE = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, detections array<struct<label string, rule string, start long, stop long>>")
_rules: list[Rule] = []


def rules() -> list[Rule]:
    if not _rules:
        _rules.extend(build_rules())
    return _rules


def word_line(text: str | None) -> tuple[bytes, int]:
    """The words joined and enclosed by single spaces, and their number."""
    words = (text or "").encode("utf-8", "replace").lower().translate(_SPACE).split()
    return b" " + b" ".join(words) + b" ", len(words)


def word_numbers(line: bytes, places: list[int]) -> list[int]:
    """The number of spaces before each place, from one pass over the line."""
    if not places:
        return []
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    return np.searchsorted(spaces, places).tolist()


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(word number, label) of every place of a base phrase."""
    found = []
    for phrase, label in BASE.items():
        at = line.find(b" " + phrase + b" ")
        while at >= 0:
            found.append((at, label))
            at = line.find(b" " + phrase + b" ", at + 1)
    return sorted(zip(word_numbers(line, [at for at, _ in found]), [label for _, label in found], strict=True))


def _union(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and stops of the stretches that the spans cover."""
    starts, stops = [], []
    for start, stop in sorted(spans):
        if stops and start <= stops[-1]:
            stops[-1] = max(stops[-1], stop)
        else:
            starts.append(start)
            stops.append(stop)
    return starts, stops


def resolve(found: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Accepted detections of (start, stop, order, rule), by place.

    One sweep a priority, highest first: what touches a stretch accepted before goes, and so
    does what lies inside a detection of its own priority (of equal ones the first rule stays).
    """
    kept: list[tuple[int, int, Rule]] = []
    by_priority: dict[int, list] = {}
    for detection in found:
        by_priority.setdefault(detection[3].priority, []).append(detection)
    for priority in sorted(by_priority, reverse=True):
        starts, stops = _union([(a, b) for a, b, _ in kept])
        reach = -1
        for start, stop, _, rule in sorted(by_priority[priority], key=lambda d: (d[0], -d[1], d[2])):
            at = bisect_right(stops, start)  # the first stretch that ends after the start
            if stop > reach and not (at < len(starts) and starts[at] < stop):
                kept.append((start, stop, rule))
                reach = stop
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].label))


def detections(line: bytes) -> list[tuple[int, int, Rule]]:
    if not any(gate in line for gate in GATES):
        return []
    known: dict[bytes, bool] = {}
    found = []
    for order, rule in enumerate(rules()):
        present = known.get(rule.keyword)
        if present is None:
            present = known[rule.keyword] = rule.keyword in line
        if present:
            found += [(m.start(), m.end(), order, rule) for m in rule.pattern.finditer(line)]
    return resolve(found)


def scan_text(text: str | None) -> tuple:
    line, n_words = word_line(text)
    if n_words == 0:
        return 0, 0, None, None, "", "", 0.0, []
    base, found = base_places(line), detections(line)
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(rule.label for *_, rule in found)})
    best: dict[str, float] = {}
    for *_, rule in found:
        best[rule.label] = max(best.get(rule.label, 0.0), rule.confidence)
    doubt = 1.0
    for label in labels:
        doubt *= 1 - best.get(label, 0.5)
    numbers = word_numbers(line, [at for a, b, _ in found for at in (a, b)])
    spans = [{"label": r.label, "rule": r.kind, "start": start - 1, "stop": stop}
             for (*_, r), start, stop in zip(found, numbers[::2], numbers[1::2], strict=True)]
    return (n_words, len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(base_labels), ",".join(labels), 1 - doubt if labels else 0.0, spans)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Words, base places, labels, score and accepted detections (in words) of every row."""
    names = [part.split()[0] for part in SCHEMA.split(", ")[:8]] + ["detections"]
    span = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), span]

    def scan(batches):
        for batch in column_batches(batches):
            rows = list(zip(*map(scan_text, batch.column(1).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(rows, types, strict=True))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, SCHEMA)
