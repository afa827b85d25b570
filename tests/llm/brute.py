"""Plain versions of the operators, over Python lists."""

import hashlib
import re
from collections import defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def without_repeats(docs, length):
    """(n_words, n_removed, kept) of each (doc_id, text)."""
    words = [WORD.findall(text or "") for _, text in docs]
    first = {}
    for (doc_id, _), own in zip(docs, words):
        for at in range(len(own) - length + 1):
            window = tuple(own[at : at + length])
            if doc_id is not None:
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for (doc_id, _), own in zip(docs, words):
        gone = [False] * len(own)
        for at in range(len(own) - length + 1):
            low = first.get(tuple(own[at : at + length]))
            if doc_id is not None and low is not None and low < doc_id:
                gone[at : at + length] = [True] * length
        kept = [word for word, out_ in zip(own, gone) if not out_]
        out.append((len(own), len(own) - len(kept), " ".join(kept)))
    return out


def simhash(text, n=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, most=2):
    """Smallest place reachable from each place."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def base_spans(text):
    assign = re.compile(
        r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def top_k(rows, k, every):
    found = []
    for query_id, query in rows:
        if query_id % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(query, vector)), vec_id)
            for vec_id, vector in rows
            if vec_id != query_id
        ]
        for rank, (score, vec_id) in enumerate(sorted(scored)[:k], start=1):
            found.append((query_id, rank, vec_id, -score))
    return found


def groups(pairs):
    out = defaultdict(list)
    for key, value in pairs:
        out[key].append(value)
    return out
