"""Plain restatements of the corpus operators on small inputs."""

import hashlib
import math
import re
from collections import Counter


def shingle_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def components(sets, percent=75):
    """Smallest reachable key of each key of a dict of sets."""
    keys = sorted(sets)
    root = {k: k for k in keys}
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def removed(rows, length=100):
    """(bytes, removed bytes, spans, digest of the rest) of each id; ``None`` sorts first."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        body, spans = (text or "").encode(), []
        for start in range(len(body) - length + 1):
            string = body[start : start + length]
            if string not in seen:
                seen.add(string)
            elif spans and start <= spans[-1][1]:
                spans[-1][1] = start + length
            else:
                spans.append([start, start + length])
        gone = {i for a, b in spans for i in range(a, b)}
        kept = bytes(x for i, x in enumerate(body) if i not in gone)
        out[key] = (len(body), len(gone), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def secret_matches(text):
    """(start, kind number, end) of the base spans, in order."""
    assign = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def joined_spans(found):
    return ",".join(f"{('assign', 'access', 'hex', 'entropy')[k]}:{a}:{b}" for a, k, b in sorted(found))


def secret_base(text):
    return joined_spans(secret_matches(text))


def bits(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def secret_spans(text, bars, allowed, window=20):
    """All spans of a text, every window's entropy computed afresh."""
    found = secret_matches(text)
    for candidate in re.finditer("[A-Za-z0-9+/=_-]+", text):
        free, (low, high) = [], candidate.span()
        for start, end in [*sorted((a, b) for a, _, b in found if a < high and b > low), (high, high)]:
            if start - low >= window:
                free.append((low, start))
            low = max(low, end)
        for low, high in free:
            own = text[low:high]
            pieces = [m.span() for m in re.finditer("[^=/]+", own)]
            spans = []
            for a, b in {(0, len(own)), *pieces}:
                kinds = (("digits", "[0-9]+"), ("hex", "[0-9a-f]+|[0-9A-F]+"), ("letters", "[A-Za-z]+"), ("alphanumeric", "[A-Za-z0-9]+"))
                kind = next((k for k, p in kinds if re.fullmatch(p, own[a:b])), "base64")
                dense = {j for i in range(a, b - window + 1) if bits(own[i : i + window]) >= bars[kind] - 1e-9 for j in range(i, i + window)}
                # Windows that touch without overlapping form one span.
                spans += [(min(run), max(run) + 1) for run in runs(dense)]
            spans = [x for x in spans if not all(any(re.fullmatch(p, own[a:b]) for p in allowed) for a, b in pieces if a < x[1] and b > x[0])]
            covered = {i for a, b in spans for i in range(a, b)}
            found += [(low + min(run), 3, low + max(run) + 1) for run in runs(covered)]
    return found


def sections(text, pieces):
    """(start, end, tokens, crossing tokens) of each line, a break belonging to the line it ends."""
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n"]
    ends = [*starts[1:], len(text)]
    counts, at = [[0, 0] for _ in starts], 0
    for piece in pieces:
        first, last = char_of[at], char_of[at + len(piece) - 1] + 1
        at += len(piece)
        held = [max(0, min(b, last) - max(a, first)) for a, b in zip(starts, ends, strict=True)]
        own = held.index(max(held))
        counts[own][0] += 1
        counts[own][1] += sum(x > 0 for x in held) > 1
    return [(a, b, *n) for a, b, n in zip(starts, ends, counts, strict=True)]


def runs(places):
    out = []
    for i in sorted(places):
        if out and out[-1][-1] == i - 1:
            out[-1].append(i)
        else:
            out.append([i])
    return out
