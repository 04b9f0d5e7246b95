"""The rows of an XML file and what they lie in, told while a task reads a stretch of it."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

#: What follows the < of a text in which nothing is a tag, and what ends it.
HIDING = {"!--": "-->", "![CDATA[": "]]>", "?": "?>"}
ENTITY = re.compile("&(?:#([0-9]{1,9})|#x([0-9a-fA-F]{1,8})|(lt|gt|quot|apos|amp));")
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")


def _meant(m: re.Match) -> str:
    if m[3]:
        return NAMED[m[3]]
    code = int(m[1]) if m[1] else int(m[2], 16)
    return chr(code) if 0 < code < 0xD800 or 0xDFFF < code < 0x110000 else m[0]


class Scan:
    """What is open at a place of a file: a hiding text, rows and enclosing elements; ``scan`` takes the text behind it, a part at a time.

    A part begins with a < or the file and ends before a <, so a tag is in one part; a row may run over many. Ends of rows and
    of elements that were opened before the scan began are counted, for summed() to take off from what was open there.
    """

    def __init__(self, row_tag: str, outer_tag: str, attributes: list[str], state: dict | None = None):
        hiding, names = "|".join(map(re.escape, HIDING)), "|".join(map(re.escape, sorted({row_tag, outer_tag})))
        # possessive, as tags may be long; a > may stand in a quoted value
        self.event = re.compile(f"""<(?:({hiding})|(/?)({names})(?=[\\s/>])((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+))""")
        self.row_tag, self.outer_tag, self.attributes = row_tag, outer_tag, attributes
        state = state or {}
        self.hidden, self.depth, self.outer = state.get("hidden", ""), state.get("depth", 0), list(state.get("outer", []))
        self.opened = state.get("opened")  # the stretch in which the row that is open has begun
        self.held, self.around = [], None  # its text so far and the attributes around it
        self.row_ends = self.outer_ends = 0

    def _values(self, tag: str) -> list:
        found = {}
        for m in ATTRIBUTE.finditer(tag):
            found.setdefault(m[1], ENTITY.sub(_meant, m[2] if m[2] is not None else m[3]))
        return [found.get(a) for a in self.attributes]

    def scan(self, text: str):
        """Yields (row's text, its begin's stretch, attributes around it) of each row that ends in ``text``."""
        at, begin, none = 0, 0, [None] * len(self.attributes)
        while True:
            if self.hidden:
                end = text.find(HIDING[self.hidden], at)
                if end < 0:
                    break
                at, self.hidden = end + len(HIDING[self.hidden]), ""
            m = self.event.search(text, at)
            if m is None:
                break
            at = m.end()
            if m[1]:
                self.hidden = m[1]
                continue
            closes, name, tag = m[2], m[3], m[4]
            alone, end = not closes and tag.endswith("/"), at + text.startswith(">", at)
            if name == self.row_tag:
                if not closes and self.depth == 0:
                    begin, self.opened, self.around = m.start(), None, self.outer[-1] if self.outer else none
                if alone:
                    if self.depth == 0:
                        yield text[begin:end], None, self.around
                elif not closes:
                    self.depth += 1
                elif self.depth == 0:
                    self.row_ends += 1
                else:
                    self.depth -= 1
                    if self.depth == 0:
                        yield "".join([*self.held, text[begin:end]]), self.opened, self.around
                        self.held = []
            if name == self.outer_tag:
                if closes:
                    if self.outer:
                        self.outer.pop()
                    else:
                        self.outer_ends += 1
                elif not alone:
                    self.outer.append(self._values(tag))
        if self.depth:
            self.held.append(text[begin:])

    def summary(self) -> dict:
        return {"hidden": self.hidden, "row_ends": self.row_ends, "depth": self.depth, "outer_ends": self.outer_ends, "outer": self.outer}


def summed(state: dict, start: int, stretch: dict) -> dict:
    """What is open behind a stretch, from what is open before it and the stretch's summary."""
    rest = max(0, state["depth"] - stretch["row_ends"])
    outer = state["outer"][: max(0, len(state["outer"]) - stretch["outer_ends"])] + stretch["outer"]
    opened = state["opened"] if rest else start if stretch["depth"] else None
    return {"hidden": stretch["hidden"], "depth": rest + stretch["depth"], "outer": outer, "opened": opened}


def _parts(batches):
    """(key, start, text) of each stretch's pieces in a batch, from columns of the same names. A piece ended at a <."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        starts, keys = b.column(1).to_numpy(), b.column(0).dictionary_encode()
        codes, values = keys.indices.to_numpy(), b.column(2).to_pylist()
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (codes[1:] != codes[:-1])) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            now = keys.dictionary[codes[a].item()].as_py(), int(starts[a])
            text = "<".join(values[a:z])
            yield *now, text if now != last and now[1] == 0 else "<" + text
            last = now


SUMMARY = "key string, start long, hidden string, summary string"


def summaries(row_tag: str, outer_tag: str, attributes: list[str]):
    """For mapInArrow: a row for each stretch and each hiding text that it may begin in."""
    def rows(place, scans):
        columns = [[place[0]] * len(scans), [place[1]] * len(scans), list(scans), [json.dumps(s.summary()) for s in scans.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], names=["key", "start", "hidden", "summary"])

    def run(batches):
        place, scans = None, {}
        for key, start, text in _parts(batches):
            if place != (key, start):
                if place:
                    yield rows(place, scans)
                place = key, start
                scans = {h: Scan(row_tag, outer_tag, attributes, {"hidden": h}) for h in (["", *HIDING] if start else [""])}
            for s in scans.values():
                for _ in s.scan(text):
                    pass
                s.held = []  # no text is wanted
        if place:
            yield rows(place, scans)

    return run


STATE = "key string, start long, state string"


def states(frame):
    """For applyInPandas over a file's summaries: what is open where each of its stretches begins."""
    import pandas as pd

    state, out = {"hidden": "", "depth": 0, "outer": [], "opened": None}, []
    for start, each in frame.groupby("start", sort=True):
        out.append((each["key"].iloc[0], start, json.dumps(state)))
        state = summed(state, int(start), json.loads(dict(zip(each["hidden"], each["summary"]))[state["hidden"]]))
    return pd.DataFrame(out, columns=["key", "start", "state"])


ROW = "key string, opened long, start long, xml string, around array<string>"
#: Characters of rows in a batch.
BATCH = 4 << 20


def rows(row_tag: str, outer_tag: str, attributes: list[str], known: dict):
    """For mapInArrow: each row's text and the attributes around it. A row over several stretches comes in parts, which
    have the stretch that it was ``opened`` in. ``known`` has the states where stretches begin, other than a file's first."""
    kinds = pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["key", "opened", "start", "xml", "around"])

    def run(batches):
        place, scan, found, size = None, None, [], 0

        def rest():
            """The part of a row that is open where its stretch ends."""
            if scan is not None and scan.held:
                found.append((place[0], place[1] if scan.opened is None else scan.opened, place[1], "".join(scan.held), scan.around))

        for key, start, text in _parts(batches):
            if place != (key, start):
                rest()
                place, state = (key, start), known.get((key, start))
                scan = Scan(row_tag, outer_tag, attributes, state and json.loads(state))
            for xml, opened, around in scan.scan(text):
                found.append((key, opened, start, xml, around))
                size += len(xml)
                if size > BATCH:
                    yield batch(found)
                    found, size = [], 0
        rest()
        if found:
            yield batch(found)

    return run
