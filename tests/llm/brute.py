"""Plain versions that the operators are held against."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def jaccard_components(docs, width, part, whole):
    sets = {i: shingles(text, width) for i, text in docs}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for g in sets[i] for j in holders[g])
        for j, c in common.items():
            if whole * c >= part * (len(sets[i]) + len(sets[j]) - c):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def kept_bytes(docs, length):
    """n_bytes, n_removed, n_spans and digest of the rest by doc_id."""
    texts = [(i, (text or "").encode()) for i, text in docs]
    seen = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = {}
    for i, b in texts:
        cuts = []
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                if cuts and k <= cuts[-1][1]:
                    cuts[-1][1] = k + length
                else:
                    cuts.append([k, k + length])
        rest, at = b"", 0
        for a, e in cuts:
            rest += b[at:a]
            at = e
        rest += b[at:]
        out[i] = (len(b), sum(e - a for a, e in cuts), len(cuts), hashlib.sha256(rest).hexdigest())
    return out


PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def kept_words(docs, length):
    """doc_id, n_words, n_removed and digest of the rest for every row, in order; rows without an id come first."""
    place = [-(1 << 63) if i is None else i for i, _ in docs]
    texts = [WORD.findall(text or "") for _, text in docs]
    first = {}
    for p, words in zip(place, texts, strict=True):
        for s in range(len(words) - length + 1):
            window = tuple(words[s : s + length])
            first[window] = min(first.get(window, (p, s)), (p, s))
    out = []
    for (i, _), p, words in zip(docs, place, texts, strict=True):
        gone = set()
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] != (p, s):
                gone.update(range(s, s + length))
        rest = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """The digest above ``nodes``, and for each node its siblings (before, after) from level to level."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, above = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in under[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(digest("".join(run)))
            above.append([i for x in under[at : at + 8] for i in x])
        nodes, under = upper, above
    return nodes[0], paths


def merkle(rows):
    """Rows of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for documents' rows."""
    import zlib

    def leaf(doc, source, lang, n_chars, text):
        parts = [None if v is None else str(v) for v in (doc, source, lang, n_chars, text)]
        return digest("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))

    groups = defaultdict(list)
    for doc, text, lang, source, n_chars in rows:
        lower = None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)
        shown = text if doc is None or zlib.crc32(str(doc).encode()) % 3 else lower
        groups[lang].append((doc is not None, doc or 0, leaf(doc, source, lang, n_chars, text), leaf(doc, source, lang, n_chars, shown), doc))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in order:
        groups[lang].sort(key=lambda r: r[:3])
        built[lang] = tree([r[2] for r in groups[lang]])
    root, above = tree([built[lang][0] for lang in order])
    out = []
    for lang, beyond in zip(order, above, strict=True):
        for row, path in zip(groups[lang], built[lang][1], strict=True):
            folded = row[3]
            for before, after in path + beyond:
                folded = digest(before + folded + after)
            proof = digest("".join(b + a for b, a in path + beyond))
            out.append((row[4], row[2], built[lang][0], root, proof, folded, folded == root))
    return out


def alignments(docs, first, second, alphabet):
    """Rows of ``op13``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import bisect

    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(first)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=second)

    def ends(tokens):
        total, out = 0, []
        for t in tokens:
            total += len(t)
            out.append(total)
        return out

    rows, held = [], Counter()
    for i, text in docs:
        found = (i, 0, 0, 0, [], "")
        if text:
            a = one.encode(" " + text, add_special_tokens=False)
            b = two.encode(text)
            of_a = [bytes(alphabet[c] for c in t) for t in a.tokens]
            pieces = [(k, two.id_to_piece(k)) for k in b]
            of_b = [bytes([int(p[3:5], 16)]) if two.is_byte(k) else p.replace("▁", " ").encode() for k, p in pieces]
            if b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                end_a, end_b = ends(of_a), ends(of_b)
                cuts = sorted(set(end_a) & set(end_b))
                groups = [([], []) for _ in cuts]
                for k, e in zip(a.ids, end_a, strict=True):
                    groups[bisect.bisect_left(cuts, e)][0].append(k)
                for k, e in zip(b, end_b, strict=True):
                    groups[bisect.bisect_left(cuts, e)][1].append(k)
                links = [(x, y) for g in groups for x in g[0] for y in g[1]]
                held.update(set(links))
                text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
                found = (i, len(a.ids), len(b), len(cuts), links, digest(text))
        rows.append(found)
    best = Counter()
    for (a, _), count in held.items():
        best[a] = max(best[a], count)
    return [(i, a, b, g, len(x), sum(held[p] == best[p[0]] for p in x), sum(held[p] for p in x), s) for i, a, b, g, x, s in rows]
