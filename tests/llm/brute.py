"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import re

import xxhash

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return (text or "").translate(LOWER)


def simhash(text, size=3):
    words = re.findall("[^ \t-\r]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, linked):
    """Least value of the component of each distinct value."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def near_duplicates(docs):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    fps = [simhash(t) for _, t in docs]
    root = groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), fp in zip(docs, fps):
        if i is not None:
            least[root[fp]] = min(i, least.get(root[fp], i))
    return [(i, f"{fp:016x}", least.get(root[fp])) for (i, _), fp in zip(docs, fps)]


def decontaminate(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes = {len(w) for w in wins}
    out = []
    for i, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                got = wins.get(tuple(w[s:s + n]))
                if got is not None:
                    hit.update(range(s, s + n))
                    found |= got
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


SECRETS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, 0), ("hex", r"[0-9a-f]+", 0, 24, 0),
    ("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,12}-----END [A-Z ]{0,40}PRIVATE KEY-----"
                    r"|(?:[ \t\n\r]+[A-Za-z0-9+/=]{16,}){0,60})", 0, 0, 0), ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, 0), ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0, 0),
    ("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}", 0, 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0, 0),
    ("url_login", r"://[^\s:@/]+:[^\s:@/]+@", 0, 0, re.A)]


def secret_spans(text):
    """(start, kind number, end) by start, then kind."""
    out = []
    for n, (_, pattern, group, least, flags) in enumerate(SECRETS):
        out += [(m.start(), n, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return sorted(out)


def secrets(docs):
    out = []
    for i, text in docs:
        spans = secret_spans(text)
        said = [f"{SECRETS[k][0]}:{s}:{e}" for s, k, e in spans]
        base = ",".join(x for x, (_, k, _) in zip(said, spans) if k < 3)
        out.append((i, *(sum(k == n for _, k, _ in spans) for n in range(3)), hashlib.sha256(base.encode()).hexdigest(), ",".join(said)))
    return out


def licenses(docs):
    """The base columns: n_words, n_base, first_word, last_word, base_labels."""
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    out = []
    for i, text in docs:
        w = WORD.findall(lower(text))
        at = sorted((s, name) for p, name in phrases.items() for s in range(len(w)) if w[s:s + len(p.split())] == p.split())
        out.append((i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({n for _, n in at}))))
    return out


def license_labels(docs, templates, function_words, phrases, rare=8, agree=2):
    """All labels, by trying every template at every place with all its words; the
    score by the words that the operator looks up."""
    known = {w for _, t, _ in templates for w in t.split()} - set(function_words) | {p.split()[0] for p, _ in phrases}
    words = [WORD.findall(lower(t)) for _, t in docs]
    df = {}
    for w in words:
        for x in set(w) & known:
            df[x] = df.get(x, 0) + 1
    out = []
    for (i, _), w, base in zip(docs, words, licenses(docs)):
        labels, part = set(filter(None, base[5].split(","))), 0.0
        for name, t, keys in templates:
            t = t.split()
            size = sum(x in known for x in t)
            mine = sorted(set(w) & known & set(t), key=lambda x: (df[x], x))
            first = [x for x in mine if x in keys[0].split()][:2]
            best = (first + [x for x in mine if x not in first])[:rare]
            for place in range(-len(t), len(w)):
                at = [x for k, x in enumerate(t) if x in known and 0 <= place + k < len(w) and w[place + k] == x]
                if len(at) < min(agree, size):
                    continue
                spots = [(next(k for k in range(len(t)) if t[k:k + len(key.split())] == key.split()) + place, key.split()) for key in keys]
                if all(s >= 0 and w[s:s + len(key)] == key for s, key in spots):
                    labels.add(name)
                    part = max(part, min(1.0, sum(x in best for x in at) / min(size, rare)))
        out.append((i, ",".join(sorted(labels)), 1.0 if base[2] else part))
    return out


def spark_hash(*values):
    """xxhash64 of longs (int), ints (as ('i', n)) and strings, chained as in SQL; signed."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v[1].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def order_minhash(text, k=2, pick=2, bins=32):
    words = re.findall(r"[^ \t-\r]+", text or "")
    if not words:
        return ""
    grams = [spark_hash(*((words[i:i + k] + [""] * k)[:k])) for i in range(max(1, len(words) - k + 1))]
    low = (1 << 30) - 1
    seen, packed = {}, []
    for p, g in enumerate(grams):
        top = g >> 30
        packed.append((spark_hash(g, ("i", seen.get(top, 0))) & ~low | p))
        seen[top] = seen.get(top, 0) + 1
    sketch = {}
    for x in sorted(packed):
        sketch.setdefault((x >> 59) + bins // 2, []).append(x & low)
    values = {}
    for b, places in sketch.items():
        h = spark_hash(0)
        for p in sorted(places[:pick]):
            h = spark_hash(h, grams[p])
        values[b] = h
    out = []
    for b in range(bins):
        d = next(d for d in range(bins) if (b + d) % bins in values)
        v = values[(b + d) % bins]
        out.append(v if d == 0 else spark_hash(v, ("i", d)))
    return "".join(f"{(v & (1 << 64) - 1) >> 32:08x}" for v in out)


def alike(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) * 8 / len(a)


def order_minhash_report(docs):
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), spark_hash(r[1] or "")))
    out = []
    for j, (i, text) in enumerate(rows):
        text, after = text or "", rows[(j + 1) % len(rows)][1] or ""
        f = len(text) // 3
        edited = text[:len(text) - f] + after[:f]
        a, b, c = order_minhash(text), order_minhash(edited), order_minhash(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, c)))
    return out


def sentences(text):
    """(start, end without white space after it, words) of each sentence, in bytes."""
    data, out = (text or "").encode(), []
    for m in re.finditer(rb"[^ \t-\r]+", data):
        gap = data[out[-1][1]:m.start()] if out else b""
        if not out or b"\n" in gap or data[out[-1][1] - 1:out[-1][1]] in (b".", b"!", b"?"):
            out.append([m.start(), m.end(), 1])
        else:
            out[-1][1], out[-1][2] = m.end(), out[-1][2] + 1
    return out


def sentence_dedup(docs, least=3, words=16):
    """(doc_id, n_sentences, n_removed, text), rows in order of id and text hash."""
    rows = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, (spark_hash(r[1] or "") & (1 << 64) - 1) >> 4))
    first, cut = {}, {}
    for row in dict.fromkeys(rows):
        s = sentences(row[1])
        data = (row[1] or "").encode()
        for i in range(len(s)):
            j = next((j for j in range(i + least, len(s) + 1) if sum(x[2] for x in s[i:j]) >= words), None)
            if j is None:
                continue
            span = tuple(data[a:b] for a, b, _ in s[i:j])
            if first.setdefault(span, (row, i)) != (row, i):
                cut.setdefault(row, set()).update(range(i, j))
    out = []
    for row in rows:
        s, gone = sentences(row[1]), cut.get(row, set())
        data = (row[1] or "").encode()
        edge = [x[0] for x in s] + [len(data)]
        text = row[1] if not gone else (data[:edge[0]] + b"".join(data[edge[i]:edge[i + 1]] for i in range(len(s)) if i not in gone)).decode()
        out.append((row[0], len(s), len(gone), text))
    return out


def byte_dedup(docs, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    data = [(t or "").encode() for _, t in docs]
    count = {}
    for d in data:
        for p in range(len(d) - length + 1):
            count[d[p:p + length]] = count.get(d[p:p + length], 0) + 1
    out = []
    for (i, _), d in zip(docs, data):
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if count[d[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
