"""Small tables for the corpus operators, and brute-force versions of what they compute."""

from __future__ import annotations

import random
import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Names that operators use inside or give to results.
CLASHES = "row batch doc kept score predicted n_words ids sketch digest node bucket c0 c1 _q_text _q_in_0 text_norm size".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES)


def rows(texts):
    """Documents of texts, numbered, with columns of clashing names."""
    return [(i, t, "en", "s", len(t or ""), *["x"] * len(CLASHES)) for i, t in enumerate(texts)]


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank and long texts, repeated rows and ids, near copies, odd characters."""
    rng = random.Random(5)
    base = "\n".join(sentence(rng, 40) for _ in range(5))
    words = base.split(" ")
    near = " ".join(words[:100] + ["changed"] + words[101:])
    out = rows([
        base, base, near, None, "", " \n\t ", "one two", "one two", "é ß 日本 😀 ▁x  y", "\n".join(["same line here", "second line"] * 6),
        sentence(rng, 30_000), base + "\nTail of its own here.", "ONE TWO", "a" * 5000, "<s> <|endoftext|> </s>",
    ])
    out.append(out[0])
    out.append((None, base, None, None, None, *[None] * len(CLASHES)))
    out.append((None, None, None, None, None, *[None] * len(CLASHES)))
    out.append((2, "another text under an id that is taken", "xx", "s", 1, *["x"] * len(CLASHES)))
    return out


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked_components(texts):
    """Least reachable key of each key under links of similarity 0.85."""
    sets = {k: shingles(t) for k, t in texts.items()}
    where = {}
    for k, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(k)
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    tried = set()
    for keys in where.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                if (a, b) in tried:
                    continue
                tried.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {k: root(k) for k in sets}, {k: len(s) for k, s in sets.items()}


def without_repeats(texts, length=100):
    """Remaining bytes and removed runs of each text, in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((bytes(b for b, g in zip(data, gone) if not g), sum(gone), runs))
    return out


def without_repeated_lines(texts, run=2, alone=10):
    """Texts without lines that lie in a run that begins earlier: so many lines, or one of so many words."""
    seen, out = set(), []
    for text in texts:
        lines = (text or "").split("\n")
        worded = [j for j, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for i in range(len(worded)):
            own = [worded[i : i + run]] if i + run <= len(worded) else []
            if len(WORD.findall(lines[worded[i]])) >= alone:
                own.append(worded[i : i + 1])
            for part in own:
                key = tuple(lines[j] for j in part)
                if key in seen:
                    gone.update(part)
                seen.add(key)
        out.append(("\n".join(x for j, x in enumerate(lines) if j not in gone), len(worded), len(gone)))
    return out


def base_counts(text):
    words = WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    again = {p + j for at in windows.values() if len(at) > 1 for p in at for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again),
        len(words) < 50 or 100 * len(again) > 50 * len(words),
    )
