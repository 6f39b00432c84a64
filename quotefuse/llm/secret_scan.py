"""Secret scan with a trigram inverted index, in DataFrame operations only.

Each rule is a regular expression. ``trigram_query`` derives from it a Boolean
query that every match satisfies: a conjunction of clauses, each a disjunction
of trigram sets. The index has postings (trigram, document) for the trigrams
that occur in any query; a document's postings are intersected with every
query, and only its candidate rules are verified by their expression. A rule
without mandatory trigrams (a run of hex digits) scans every document.

Rules that ignore case look for their trigrams in the lower-cased text; this
can only add candidates. Matches are leftmost and not overlapping within a
kind; positions are code points, ends exclusive.

Defined results: null is an empty text; a document without spans has zero
counts and empty strings; equal rows are scanned alike; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import fresh


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0        # the group whose length counts
    least: int = 0        # matches with a shorter group are dropped
    any_case: bool = False  # ASCII letters match in either case


# fixed values: the base kinds, in their listed order
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# fixed values: published token formats
ADDED = (
    # to the END line, or without one over the lines of base64 that follow (60 lines of 64 hold 2.8 KB, more than an RSA key of 4,096 bits)
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,12}-----END [A-Z ]{0,40}PRIVATE KEY-----"
                        r"|(?:[\x20\x09\x0A\x0D]+[A-Za-z0-9+/=]{16,}){0,60})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[^\s:@/]+:[^\s:@/]+@"),
)
RULES = BASE + ADDED

MOST = 64  # exact strings followed at once while deriving a query


def trigram_query(pattern: str, any_case: bool = False) -> list[list[frozenset[str]]]:
    """Clauses that every match satisfies; each is a list of trigram sets of
    which one must be present whole. Empty: no trigram is mandatory."""
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if sets and frozenset() not in sets:
            clauses.append(sorted((s for s in sets if not any(o < s for o in sets)), key=sorted))

    def walk(nodes, before: set[str]) -> set[str]:
        """Strings that end where ``nodes`` end; closes what can't go on exactly."""
        for op, arg in nodes:
            name = str(op)
            if name == "LITERAL":
                step = {chr(arg)}
            elif name == "IN" and all(str(o) in ("LITERAL", "RANGE") for o, _ in arg):
                codes = set(itertools.chain.from_iterable([a] if str(o) == "LITERAL" else range(a[0], a[1] + 1) for o, a in arg))
                step = {chr(c) for c in codes} if len(codes) <= 6 else None
            elif name == "SUBPATTERN":
                before = walk(arg[-1], before)
                continue
            elif name == "BRANCH":
                ends = [walk_alone(branch) for branch in arg[1]]
                step = set().union(*ends) if None not in ends else None
            elif name == "MAX_REPEAT" and arg[1] == 1:
                inner = walk_alone(arg[2])
                step = None if inner is None else inner | ({""} if arg[0] == 0 else set())
            else:
                step = None
            if step is None or len(before) * len(step) > MOST:
                close(before)
                before = {""} if step is None else step
            else:
                before = {b + s for b in before for s in step}
        return before

    def walk_alone(nodes) -> set[str] | None:
        """The exact strings of ``nodes``, or None if they aren't a small set."""
        kept = len(clauses)
        got = walk(nodes, {""})
        exact = len(clauses) == kept and all(str(op) in ("LITERAL", "IN", "SUBPATTERN", "BRANCH", "MAX_REPEAT") for op, _ in nodes) and _small(nodes)
        del clauses[kept:]
        return got if exact else None

    def _small(nodes) -> bool:
        for op, arg in nodes:
            name = str(op)
            if name == "MAX_REPEAT" and (arg[1] != 1 or not _small(arg[2])):
                return False
            if name == "SUBPATTERN" and not _small(arg[-1]):
                return False
            if name == "BRANCH" and not all(_small(b) for b in arg[1]):
                return False
            if name == "IN" and sum(1 if str(o) == "LITERAL" else 99 for o, _ in arg) > 6:
                return False
        return True

    close(walk(re._parser.parse(pattern.lower() if any_case else pattern), {""}))
    return clauses


def _name(trigram: str, any_case: bool) -> str:
    return ("i:" if any_case else "c:") + trigram


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """doc_id, h and the numbers of the rules whose trigram query the document's postings satisfy."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern, r.any_case))}
    wanted = sorted({(r.any_case, t) for i, r in enumerate(rules) for c in queries.get(i, []) for s in c for t in s})
    low = docs.select("doc_id", "h", "text", F.lower("text").alias("low"))
    postings = low.select("doc_id", "h", F.explode(F.array_compact(F.array(*[
        F.when(F.col("low" if any_case else "text").contains(t), F.lit(_name(t, any_case))) for any_case, t in wanted
    ]))).alias("trigram"))
    lists = postings.groupBy("doc_id", "h").agg(F.collect_set("trigram").alias("held"))

    def meets(i: int) -> Column:
        out = F.lit(True)
        for clause in queries[i]:
            one = F.lit(False)
            for s in clause:
                need = F.array(*[F.lit(_name(t, rules[i].any_case)) for t in sorted(s)])
                one = one | (F.size(F.array_except(need, "held")) == 0)
            out = out & one
        return out

    found = F.array_compact(F.array(*[F.when(meets(i), F.lit(i)) for i in queries]))
    return lists.select("doc_id", "h", found.alias("rules")).where(F.size("rules") > 0)


SPAN = "array<struct<start:bigint,kind:int,stop:bigint>>"


def spans_of(text: Column, number: int, rule: Rule) -> Column:
    """Spans of one rule in ``text``: the pieces between matches give the positions."""
    pattern = F.lit(("(?i)" if rule.any_case else "") + rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g).cast("long"))
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))
    cut = F.arrays_zip(F.transform(whole, lambda m: F.length(m).cast("long")).alias("m"), counted.alias("g"), between.alias("p"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("found"))

    def step(acc, x):
        begin = acc["at"] + x["p"]
        end = begin + F.coalesce(x["m"], F.lit(0).cast("long"))
        one = F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("stop"))
        good = x["m"].isNotNull() & (x["g"] >= rule.least)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(cut, start, step, lambda acc: acc["found"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with column ``spans``: (start, kind number, stop) by start, then kind."""
    h, i_, h_, r_, spans = fresh(docs, "text_hash", "scan_id", "scan_hash", "scan_rules", "spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumn(h, F.xxhash64(text))
    few = candidates(docs.select("doc_id", F.xxhash64(text).alias("h"), text.alias("text")), rules).select(
        F.col("doc_id").alias(i_), F.col("h").alias(h_), F.col("rules").alias(r_))
    joined = keyed.join(few, F.col("doc_id").eqNullSafe(F.col(i_)) & (F.col(h) == F.col(h_)), "left")
    none = F.array().cast(SPAN)
    parts = []
    for n, rule in enumerate(rules):
        indexed = bool(trigram_query(rule.pattern, rule.any_case))
        test = F.coalesce(F.array_contains(r_, n), F.lit(False)) if indexed else text.rlike(rule.pattern)
        parts.append(F.when(test, spans_of(text, n, rule)).otherwise(none))
    # explode of one value keeps the spans from being computed again by each use
    return joined.select(*docs.columns, F.explode(F.array(F.array_sort(F.flatten(F.array(*parts))))).alias(spans))


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    found = scan(docs.select("doc_id", "text"), rules)

    def count(n: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")

    counts = [count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(written(base, rules).cast("binary"), 256).alias("base_sha256"),
                        written(F.col("spans"), rules).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced; n_chars follows where it is a column."""
    found = scan(docs, rules)
    spans = found.columns[-1]
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(acc, s):
        gap = F.greatest(s["start"] - acc["at"], F.lit(0).cast("long"))
        fresh_span = F.when(s["start"] >= acc["at"], F.lit(mark)).otherwise("")
        out = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), gap.cast("int")), fresh_span)
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out"))

    new = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    hit = F.size(spans) > 0
    cleaned = found.withColumn("text", F.when(hit, new).otherwise(text))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)
