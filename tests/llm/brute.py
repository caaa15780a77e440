"""Plain single-machine versions of the contracts, for comparison on small tables."""

import hashlib
import re
import zlib


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).hexdigest()


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def crc_remainder(number, divisor):
    return zlib.crc32(str(number).encode()) % divisor


def decontaminated(documents, benchmark):
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in benchmark:
        words = pattern.findall(ascii_lower(text or ""))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in documents:
        words = pattern.findall(ascii_lower(text or ""))
        hit, items = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (found := windows.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items |= found
        out.append((doc, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def luhn(digits):
    total = 0
    for place, character in enumerate(reversed(digits)):
        value = int(character) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def personal(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, "phone", m.end()))
    return sorted(found)


def secrets(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 12:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m.group()) >= 18:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m.group()) >= 16:
            found.append((m.start(), 2, "hex", m.end()))
    return sorted(found)


def listed(found):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)


def linked(documents, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs that share a shingle."""
    sets = {}
    for doc, text in documents:
        words = re.findall("[^\x20\x09-\x0D]+", ascii_lower(text or ""))
        size = min(5, len(words))
        sets[doc] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    holders = {}
    for doc, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(doc)
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    common = {}
    for docs in holders.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return [(doc, len(own), root(doc), root(doc) == doc) for doc, own in sets.items()]


def without_repeats(documents, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen = {}
    bodies = {doc: (text or "").encode() for doc, text in documents}
    for body in bodies.values():
        for i in range(len(body) - length + 1):
            window = hash(body[i : i + length])
            seen[window] = seen.get(window, 0) + 1
    out = []
    for doc, body in bodies.items():
        kept, spans, reach, cut = bytearray(), 0, 0, False
        for i in range(len(body)):
            if i + length <= len(body) and seen[hash(body[i : i + length])] > 1:
                reach = i + length
            if i < reach:
                spans += not cut
                cut = True
            else:
                kept.append(body[i])
                cut = False
        out.append((doc, len(body), len(body) - len(kept), spans, sha(bytes(kept))))
    return out
