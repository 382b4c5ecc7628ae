"""Plain restatements of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
import tokenizers
import xxhash


def token_files(docs):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        rows.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return rows


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs):
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(docs, prints, strict=True))]


def sentencepiece_ids(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = []
    for doc_id, text in docs:
        ids = library.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        rows.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    return rows


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licenses(docs):
    rows = []
    for doc_id, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, x) for p, x in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        rows.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    return rows


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(docs):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(re.sub("[ -]", "", s)) <= 19 and _luhn(re.sub("[ -]", "", s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
    }
    rows = []
    for doc_id, text in docs:
        spans = []
        for number, (kind, (pattern, good)) in enumerate(kinds.items()):
            spans += [(m.start(), number, m.end(), kind) for m in re.finditer(pattern, text or "") if good(m[0])]
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        count = Counter(k for *_, k in spans)
        rows.append((doc_id, *(count[k] for k in kinds), hashlib.sha256(joined.encode()).hexdigest()))
    return rows


def later_copies(docs, window=50):
    first = defaultdict(lambda: None)
    order = lambda d: float("-inf") if d is None else d
    for doc_id, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - window + 1):
            key = data[i : i + window]
            if first[key] is None or order(doc_id) < first[key]:
                first[key] = order(doc_id)
    rows = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - window + 1):
            if first[data[i : i + window]] < order(doc_id):
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        rows.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def archives(pages):
    groups = defaultdict(list)
    for page_id, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            groups[data].append(page_id)
    rows = []
    for page_id, html in pages:
        data = (html or "").encode()
        least = min(groups[data], default=None)
        revisit = page_id is not None and least is not None and least != page_id
        rows.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    return rows


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def leaks(docs, items, cover=0.5, stretch=1.6, least=8):
    """(doc_id, item_id) of every document with a stretch that shares that part of an item's words in order."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    asked = [(i, words(t)) for i, t in items]
    found = set()
    for doc_id, text in docs:
        have = words(text)
        for item_id, want in asked:
            if len(want) < least:
                continue
            n, size = len(want), int(stretch * len(want))
            for at in range(0, max(1, len(have) - size // 2), max(1, n // 8)):
                part = have[at : at + size]
                if sum(w in set(part) for w in want) >= cover * n and lcs(want, part) >= cover * n:
                    found.add((doc_id, item_id))
                    break
    return found
