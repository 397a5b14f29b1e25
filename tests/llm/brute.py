"""Plain versions of the operators, for small fixtures."""

import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

TEXTS = [
    "One two three four five six seven eight nine ten eleven twelve.",
    "one TWO three four five six seven eight nine ten eleven twelve.",
    "One two three four five six seven eight nine ten eleven other",
    "",
    None,
    " \t\n ",
    "short text",
    "Short  TEXT",
    "Mail x.y@mail.example.com or +49 30 1234567, card 4111 1111 1111 1111, host 10.0.0.255 and 256.1.1.1",
    "mail a@b.c%d@e.f and 1.2.3.4.5.6.7.8 é😀 z@y.x",
    "a\nline\nline\n\nline b\nsharp ### $$$ | <>",
    " ".join(["again and again"] * 30),
    " ".join(f"w{i}" for i in range(9000)) + " x" * 50,
    "You stupid idiot! He said \"not an idiot\" to you.",
    "Straße ÄÖÜ naïve İstanbul ΣΑΣ 12345 ½ 你好 <|endoftext|> it's I'LL",
]


def documents(spark, rows=None, extra=True):
    """(doc_id, text) rows as a table with clashing extra columns, nulls and repeated rows."""
    if rows is None:
        rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1]), (None, None)]
    schema = "doc_id long, text string" + ", lang string, source string, n_chars long, n_words long, score double, kept string, rule int" * extra
    return spark.createDataFrame([(i, t, *([None] * 7 if extra else [])) for i, t in rows], schema)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """(n_shingles, component) of each row of (id, text), by all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= 85 * len(a | b)]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            least = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = least
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((len(sets[i]), (min(ids) if ids else None) if sets[i] else own))
    return out


def pii(text):
    text = text or ""
    out = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(f"card:{m.start()}:{m.end()}")
    out += [f"phone:{m.start()}:{m.end()}" for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(out)


def entities(text):
    """(start, end, entities) of each base span."""
    out = []
    for span in filter(None, pii(text).split(",")):
        kind, a, b = span.split(":")
        a, b = int(a), int(b)
        value = text[a:b].lower()
        own = re.sub("[^0-9]", "", value) if kind in ("card", "phone") else re.sub("(?<![0-9])0+(?=[0-9])", "", value) if kind == "ip" else value
        out.append((a, b, [f"{kind}:{own}"] + [f"domain:{value.split('@')[-1]}"] * (kind == "email")))
    return out


def terms(text):
    return set(re.findall(r"[^\W\d_]{3,}", text.lower()))


def disclosures(rows, reach=80, prior=1.0, gain=1.0, most=1.0):
    """(entity, term) -> bits that the term leaves, of the terms that disclose an entity."""
    sign = lambda s: (xxhash.xxh64(s.encode(), seed=42).intdigest() + 2**63) % 2**64 - 2**63
    near, mentioned, seen = defaultdict(dict), defaultdict(set), Counter()
    for i, text in rows:
        text = text or ""
        seen.update(terms(text))
        for a, b, own in entities(text):
            around = text[max(a - reach, 0) : a] + " " + text[b : b + reach]
            for entity in own:
                mentioned[entity].add(around)
                for term in terms(around):
                    doc = near[entity, term]
                    doc[i, text] = min(doc.get((i, text), 2**63), sign(around))
    out = {}
    for (entity, term), docs in near.items():
        if not seen[term]:
            continue  # cut off at the edge of a context, and no word of any text
        contexts, usual = len(set(docs.values())), min(1, len(mentioned[entity]) / max(len(rows), 2))
        share = (contexts + prior * usual) / (contexts + max(seen[term] - len(docs), 0) + prior)
        if -math.log2(share) <= most and math.log2(share / usual) >= gain:
            out[entity, term] = -math.log2(share)
    return out


def redacted(text, found, removed=0.415):
    """``text`` with marks for its base spans and for the terms that disclose (by ``disclosures``) what it mentions."""
    base = [(int(a), int(b), f"[{kind.upper()}]") for kind, a, b in (x.split(":") for x in pii(text).split(",") if x)]
    own = {e for _, _, es in entities(text) for e in es}
    rest = {}
    for (entity, term), bits in found.items():
        if entity in own:
            rest[term] = min(bits, rest.get(term, bits))
    words = [(m.start(), m.end(), "" if rest[m[0].lower()] <= removed else "[TERM]") for m in re.finditer(r"[^\W\d_]+", text) if m[0].lower() in rest]
    spans = base + [w for w in words if not any(a < w[1] and w[0] < b for a, b, _ in base)]
    for a, b, mark in sorted(spans, reverse=True):
        text = text[:a] + mark + text[b:]
    return text


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def contamination(text, items):
    """n_words, n_hit, sorted items."""
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    own, hit, found = find(text), set(), set()
    for item, other in items:
        w = find(other)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for i in range(len(own) - n + 1):
                if own[i : i + n] == w[k : k + n]:
                    hit |= set(range(i, i + n))
                    found.add(str(item) if item is not None else "")
    return len(own), len(hit), sorted(found)


def base_scores(rows, held_out):
    """n_tokens, n_known, train_tokens, base score of each (id, text) row."""
    tokens = [[*words(t), None] for _, t in rows]
    count = Counter(x for (i, _), own in zip(rows, tokens, strict=True) if not held_out(i) for x in own)
    total, kinds = sum(count.values()), len(count)
    return [(len(own), sum(count[x] > 0 for x in own), total, sum(math.log10((count[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in own)) for own in tokens]


def remainder(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus
