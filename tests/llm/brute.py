"""Plain versions of the operators, to hold their results against."""

import re

import xxhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(marks, radius=4):
    """doc_id to the smallest doc_id that links reach, of (doc_id, fingerprint)."""
    root = {d: d for d, _ in marks}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(marks):
        for b, y in marks[:i]:
            if (x ^ y).bit_count() <= radius:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d in root}


def kept_lines(rows, similarity=0.8):
    """doc_id to the text without lines that resemble an earlier one, of (doc_id, text)."""
    earlier, out = [], {}
    for d, text in sorted(rows):
        kept = []
        for line in (text or "").split("\n"):
            words = set(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
            similar = bool(words) and any(len(words & e) >= similarity * len(words | e) - 1e-9 for e in earlier)
            if words:
                earlier.append(words)
            if not similar:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


def edits(pattern, text):
    """Fewest edits that turn the pattern into any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def contaminated(docs, items, q=10, budget=0.06):
    """(doc_id, item_id) of all pairs within the edit budget."""
    plain = lambda t: " ".join((t or "").lower().split())
    out = set()
    for d, text in docs:
        for n, item in items:
            t, p = plain(text), plain(item)
            if p and (re.search(("\\b" if p[0].isalnum() else "") + re.escape(p) + ("\\b" if p[-1].isalnum() else ""), t) is not None if len(p) < q else edits(p, t) <= max(0, min(int(budget * len(p)), (len(p) - q) // q))):
                out.add((d, n))
    return out
