"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

import pandas as pd

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def documents(sf_dir: str) -> dict[int, str]:
    found = pd.read_parquet(f"{sf_dir}/documents.parquet")
    return {int(d): t or "" for d, t in zip(found.doc_id, found.text)}


def smallest(nodes, links) -> dict:
    """The smallest node that each node is connected with."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def measurements(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words, windows, repeated = WORD.findall(text), collections.defaultdict(list), set()
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    for at in windows.values():
        if len(at) > 1:
            repeated.update(j for i in at for j in range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def without_repeats(texts: dict[int, str], length: int) -> dict[int, tuple]:
    """n_bytes, n_removed, n_spans, digest of what stays."""
    data, first, out = {d: texts[d].encode() for d in sorted(texts)}, {}, {}
    for d, b in data.items():
        for i in range(len(b) - length + 1):
            first.setdefault(b[i:i + length], d)
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[d] = len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))
    return out


def shingles(text: str, size: int) -> frozenset:
    words = WORD.findall(text.translate(UPPER))
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def similar(sets: list[frozenset], percent: int) -> list[tuple[int, int]]:
    """Index pairs of sets at least so similar."""
    holds, common = collections.defaultdict(list), collections.Counter()
    for i, s in enumerate(sets):
        for x in s:
            common.update((j, i) for j in holds[x])
            holds[x].append(i)
    return [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def near_duplicates(texts: dict[int, str], size: int, percent: int) -> dict[int, tuple[int, int]]:
    """Set size and component of each document."""
    ids = sorted(texts)
    sets = [shingles(texts[d], size) for d in ids]
    root = smallest(ids, [(ids[a], ids[b]) for a, b in similar(sets, percent)])
    return {d: (len(s), root[d]) for d, s in zip(ids, sets)}


FILTERS = "ABCDE"


def failing(texts: dict[int, str]) -> dict[int, str]:
    """The filters that each document fails."""
    first: dict[str, int] = {}
    for d in sorted(texts):
        first.setdefault(texts[d], d)
    out = {}
    for d, text in texts.items():
        words = WORD.findall(text)
        tests = (len(words) < 50, 100 * len(set(words)) < 65 * len(words),
                 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text), first[text] < d)
        out[d] = "".join(letter for letter, fails in zip(FILTERS, tests) if fails)
    return out


def audit(fails: list[tuple[str, str, int, int]]) -> dict[tuple, tuple]:
    """All counts of rows ``part, failed filters, good, toxic``, each order applied document by document."""
    out = {}
    for part in {row[0] for row in fails}:
        rows, shapley = [row for row in fails if row[0] == part], collections.Counter()
        found = {}
        for order in map("".join, itertools.permutations(FILTERS)):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                shapley[letter] += len(gone)
                found[part, order, step] = [
                    len(left), len(gone), sum(letter in r[1] for r in rows) - len(gone), sum(letter == r[1] for r in rows),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        out |= {key: (*found[key], shapley[key[1][key[2] - 1]]) for key in found}
    return out


def damage(rows: list[tuple]) -> list[tuple]:
    """Rows ``conv_id, turn, role, text`` as the checksum damages them, each conversation's in order."""
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        deal = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text
        out += [(conv, turn, "user" if deal == 4 else role, text)] * {0: 0, 3: 2}.get(deal, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))


def mend(rows: list[tuple]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired turns of one conversation's ordered rows."""
    seen, faults, counts = set(), [], collections.Counter()
    for _, _, role, text in rows:
        words = WORD.findall(text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1][-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ()), "s": (4, "II", (("user", ""), ("assistant", ""))), "u": (2, "I", (("assistant", ""),)), "a": (0, "", ())}
    for (_, _, role, text), fault in list(zip(rows, faults))[::-1]:
        plain = {}
        for state in best:
            options = [(best[state][0] + 3, "D" + best[state][1], best[state][2])]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                for cost, label, initial, to in [(0, "K", role[:1], role), (2, "R", "u", "user"), (2, "R", "a", "assistant")]:
                    after = step.get((state, initial))
                    if after:
                        rest = best[after]
                        options.append((cost + extra + rest[0], label + rest[1], ((to, text), *rest[2])))
            plain[state] = min(options)
        best = plain
        for _ in range(2):
            for state in best:
                for to in ("user", "assistant"):
                    after = step.get((state, to[0]))
                    if after:
                        rest = best[after]
                        best[state] = min(best[state], (2 + rest[0], "I" + rest[1], ((to, ""), *rest[2])))
    cost, edits, turns_ = best[""]
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, edits, turns_
