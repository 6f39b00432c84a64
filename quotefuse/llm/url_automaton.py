"""URL filter by a bit-parallel wildcard automaton.

Rules become globs over the canonical URL, host and path without scheme, query
and fragment (host: after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end). In a
glob ``*`` stands for any run without ``/``, ``**`` for any run, ``?`` for one
character other than ``/``, and a backslash takes the next character as it is.

All globs are packed one after the other into the bits of several 64-bit words,
a bit per state. For every byte class of the alphabet there are two masks: the
states that may be entered by such a byte and the states that stay on it (the
wildcards). One step of the simulation, ``(D << 1 & enter[c]) | (D & stay[c])``
with the carry between the words, moves all globs at once, for all URLs of a
block of rows; bytes of UTF-8 are the alphabet, and ``?`` stays on the
continuation bytes of its character. The masks are broadcast: their size is
that of the rules.

A rule (action, host, path) fits its host and all subdomains, if the path
starts with the rule's; the longest fitting rule decides (equal lengths: the
longer host, then block). Without one, the method's own globs decide: the one
with most literal characters, equal ones block; without any the URL is allowed.

Defined results: a null url or one without ``://`` has an empty host and path
and no rule; an empty path does not start with ``/``; repeated rows are judged
each; a url of any length is read whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import text_slices

ALLOW, BLOCK = "allow", "block"
CELLS = 1 << 19  # words of state that one block of rows may hold
SETTLE = 16      # steps between looks for URLs whose result stands

# The method's own globs, by host and by path.
GLOBS = (
    (BLOCK, "*adult**"), (BLOCK, "*casino**"), (BLOCK, "*cheap-pills**"), (BLOCK, "*porn**"), (BLOCK, "*xxx**"),
    (BLOCK, "ads.**"), (BLOCK, "*.ads.**"), (BLOCK, "**/wp-login.php"), (BLOCK, "**/wp-admin/**"),
    (BLOCK, "**/cgi-bin/**"), (BLOCK, "**.exe"), (BLOCK, "**.zip"), (BLOCK, "*.*/*/login"), (ALLOW, "*.adult-education.*/**"),
)

SLASH = 0x2F
ANY, SEGMENT = "**", "*"  # the two loops


@dataclass(frozen=True)
class Pattern:
    """A glob as steps: bytes, ``None`` for ``?``, and loops between them."""
    steps: tuple            # int (a byte) or None
    loops: tuple            # per state (len(steps) + 1): "", SEGMENT or ANY
    number: int             # the rule it stands for


def steps_of(glob: str) -> tuple[list, list]:
    """The steps of a glob and the loop of each state."""
    steps, loops, at = [], [""], 0
    while at < len(glob):
        if glob.startswith(ANY, at):
            loops[-1], at = ANY, at + 2
        elif glob[at] == SEGMENT:
            loops[-1], at = loops[-1] or SEGMENT, at + 1
        elif glob[at] == "?":
            steps.append(None)
            loops.append("")
            at += 1
        else:
            at += glob[at] == "\\" and at + 1 < len(glob)
            for byte in glob[at].encode("utf-8"):
                steps.append(byte)
                loops.append("")
            at += 1
    return steps, loops


def literal(text: str) -> str:
    """``text`` as a glob that fits only itself."""
    return "".join(f"\\{c}" if c in "*?\\" else c for c in text)


def rule_globs(host: str, path: str) -> list[str]:
    """Globs of a rule: its host and its subdomains, then paths that start with the rule's."""
    tails = [literal(path) + ANY] if path else ["", "/" + ANY]
    return [head + literal(host) + tail for head in ("", "*.") for tail in tails]


class Automaton:
    """Masks of all patterns. ``classes`` maps a byte to its column of the masks."""

    def __init__(self, patterns: Sequence[Pattern]):
        used = sorted({s for p in patterns for s in p.steps if s is not None} | {SLASH})
        # classes: the bytes that rules name, any other first byte of a character, continuation bytes
        self.classes = np.zeros(256, dtype=np.intp)
        self.classes[0x80:0xC0] = 1
        for i, byte in enumerate(used):
            self.classes[byte] = i + 2
        size = len(used) + 2
        following = np.array([False, True] + [0x80 <= b < 0xC0 for b in used])
        slash = np.array([False, False] + [b == SLASH for b in used])
        bits = sum(len(p.steps) + 1 for p in patterns)
        self.words = max(1, -(-bits // 64))
        enter, stay = np.zeros((size, self.words * 64), bool), np.zeros((size, self.words * 64), bool)
        first, last, absorbing = np.zeros((3, self.words * 64), bool)
        self.ends, at = [], 0
        for p in patterns:
            first[at] = True
            for i, loop in enumerate(p.loops):
                if i:
                    step = p.steps[i - 1]
                    if step is None:
                        enter[:, at + i] = ~following & ~slash
                        stay[following, at + i] = True
                    else:
                        enter[self.classes[step], at + i] = True
                if loop:
                    stay[:, at + i] |= True if loop == ANY else ~slash
            at += len(p.steps) + 1
            last[at - 1], absorbing[at - 1] = True, p.loops[-1] == ANY
            self.ends.append(at - 1)
        self.enter, self.stay, self.first, self.last, self.absorbing = (
            np.packbits(x, axis=-1, bitorder="little").view("<u8") for x in (enter, stay, first, last, absorbing))

    def run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Accepting states of every string: (rows, words)."""
        state = np.tile(self.first, (len(starts), 1))
        rows = np.argsort(-lengths, kind="stable")
        for step in range(int(lengths.max(initial=0))):
            if step % SETTLE == 0:
                rows = rows[(state[rows] & ~self.absorbing).any(axis=1)]
            rows = rows[: np.searchsorted(-lengths[rows], -step, side="left")]
            if not len(rows):
                break
            kind = self.classes[data[starts[rows] + step]]
            now = state[rows]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[rows] = (moved & self.enter[kind]) | (now & self.stay[kind])
        return state & self.last

    def accepts(self, hits: np.ndarray, pattern: int) -> np.ndarray:
        end = self.ends[pattern]
        return (hits[:, end // 64] >> np.uint64(end % 64)) & np.uint64(1) == 1


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ordered(rules: Sequence[tuple[str, str, str]], globs: Sequence[tuple[str, str]]) -> tuple[list, list]:
    """(verdict, rule, glob) of every rule and glob, the least first, and their patterns."""
    plain = lambda g: sum(s is not None for s in steps_of(g)[0])
    own = sorted(globs, key=lambda g: (plain(g[1]), g[0] == BLOCK, g[1]))
    base = sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == BLOCK))
    said = [(v, None, g) for v, g in own] + [(v, h + p, None) for v, h, p in base]
    texts = [[g] for _, g in own] + [rule_globs(h, p) for _, h, p in base]
    return said, [Pattern(*map(tuple, steps_of(g)), number) for number, gs in enumerate(texts) for g in gs]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], globs: Sequence[tuple[str, str]] = GLOBS) -> DataFrame:
    """page_id, host, path, rule, verdict, own_glob (the method's, where it decided) for every row of ``pages``."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("whole", F.concat("host", "path"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    said, patterns = ordered(rules, globs)
    known = pages.sparkSession.sparkContext.broadcast((said, patterns, Automaton(patterns)))

    def run(batches):
        said, patterns, automaton = known.value
        result = [pa.array([None, *(s[i] for s in said)], pa.string()) for i in (1, 0, 2)]
        for b in text_slices(batches, "whole", rows=max(64, CELLS // automaton.words)):
            texts = b.column("whole").cast(pa.binary())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
            hits = automaton.run(data, offsets[:-1], np.diff(offsets))
            best = np.zeros(len(texts), dtype=np.int64)  # 0: none
            for i, p in enumerate(patterns):
                np.maximum(best, np.where(automaton.accepts(hits, i), p.number + 1, 0), out=best)
            rule, verdict, glob = (x.take(pa.array(best)) for x in result)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("host"), b.column("path"), rule, verdict.fill_null(ALLOW), glob],
                ["page_id", "host", "path", "rule", "verdict", "own_glob"])

    return rows.mapInArrow(run, f"page_id {id_type}, host string, path string, rule string, verdict string, own_glob string")
