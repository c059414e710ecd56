"""Plain Python versions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WS = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def secrets(text: str | None) -> tuple:
    text = text or ""
    kinds = [
        ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    ]
    counts, spans = [], []
    for i, (kind, pattern, group, least) in enumerate(kinds):
        own = [m.span() for m in pattern.finditer(text) if len(m.group(group)) >= least]
        counts.append(len(own))
        spans += [(s, i, e, kind) for s, e in own]
    said = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
    return (*counts, hashlib.sha256(said.encode()).hexdigest())


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WS.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WS.search(x)]
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n


def ratios(text: str | None) -> tuple:
    """symbol, repeated-line, repeated-word ratio and mean word length."""
    n, chars, symbols, dup, rep, _ = quality(text)
    lines = sum(1 for x in (text or "").split("\n") if WS.search(x))
    return tuple(a / b if b else 0.0 for a, b in ((symbols, chars), (dup, lines), (rep, n), (chars, n)))


def quantile(values: list[float], per_mille: int) -> float:
    """Exact: the least value that at least ``per_mille`` of a thousand do not exceed."""
    return sorted(values)[-(-per_mille * len(values) // 1000) - 1]


SPREADS = (0.02, 0.1, 0.05, 0.25)


def quality_fences(rows: list[tuple], reach: float, prior_rows: int, growth: float = 1.02) -> dict[tuple, list[tuple[float, float]]]:
    """(lang, source) to (low, high) of each ratio, from rows (lang, source, text), by exact quartiles at the sketch's bin edges."""
    sound = [(lang, source, ratios(t)) for lang, source, t in rows if not quality(t)[5]]

    def edges(own: list[float]) -> tuple[float, float]:
        def edge(x: float, down: int) -> float:
            return growth ** (math.ceil(math.log(x) / math.log(growth)) - down) if x else 0.0

        return edge(quantile(own, 250), 1), edge(quantile(own, 750), 0)

    def lean(own: list, parent: tuple[float, float]) -> tuple[float, float]:
        return tuple((len(own) * e + prior_rows * p) / (len(own) + prior_rows) for e, p in zip(edges(own), parent, strict=True))

    def fence(quarter: tuple, spread: float, parent: tuple | None) -> tuple[float, float, float]:
        """low, high, and the distance of fence and quartile; the parent's own such distance is how far beyond its fence one may go."""
        width = reach * max(quarter[1] - quarter[0], spread)
        low, high = quarter[0] - width, quarter[1] + width
        return (low, high, width) if parent is None else (max(low, parent[0] - parent[2]), min(high, parent[1] + parent[2]), width)

    out = defaultdict(list)
    for k, spread in enumerate(SPREADS):
        root = edges([r[k] for _, _, r in sound])
        widest = fence(root, spread, None)
        for lang, source in {x[:2] for x in sound}:
            of_lang = lean([r[k] for a, _, r in sound if a == lang], root)
            own = lean([r[k] for a, b, r in sound if (a, b) == (lang, source)], of_lang)
            out[lang, source].append(fence(own, spread, fence(of_lang, spread, widest))[:2])
    return out


def quality_kept(rows: list[tuple], reach: float = 3.0, prior_rows: int = 100) -> list[bool]:
    fences = quality_fences(rows, reach, prior_rows)
    out = []
    for lang, source, text in rows:
        bad = quality(text)[5]
        if not bad:
            for k, (x, (low, high)) in enumerate(zip(ratios(text), fences[lang, source], strict=True)):
                bad |= x > high or (k == 3 and x < low)
        out.append(not bad)
    return out


def shingles(text: str | None, size: int) -> frozenset:
    words = WS.findall(fold(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(docs: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t, size) for d, t in docs}
    root = {d: d for d in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def removed(docs: list[tuple[int, str | None]], size: int = 50) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    raw = {d: (t or "").encode() for d, t in docs}
    for d in sorted(raw):
        for i in range(len(raw[d]) - size + 1):
            first.setdefault(raw[d][i : i + size], d)
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def contamination(text: str | None, items: list[tuple[str, str | None]], size: int = 13) -> tuple:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = word.findall(fold(text or ""))
    where = defaultdict(list)
    hit, found = set(), set()
    for length in range(1, size + 1):
        for i in range(len(words) - length + 1):
            where[tuple(words[i : i + length])].append(i)
    for item, t in items:
        own = word.findall(fold(t or ""))
        windows = [tuple(own)] if 0 < len(own) < size else [tuple(own[i : i + size]) for i in range(len(own) - size + 1)]
        for w in windows:
            for i in where.get(w, []):
                found.add(item)
                hit.update(range(i, i + len(w)))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def pieces_ok(rows: list, docs: list[tuple[int, str | None]], encode) -> None:
    """Pieces cover every document's ids once, and sequences have no gap or overflow."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for d, t in docs:
        ids = [*encode(t or ""), 0]
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            own = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))
            at += r["length"]
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url(url: str | None) -> tuple:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (fold(m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[1] if best else None, best[2] if best else None
