"""Plain versions of the operators for small inputs: no Spark, no vectors, no index."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from typing import NamedTuple

LICENCE_LINE = "Released under the MIT License."


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n):
    w = words(lower(text))
    return frozenset([tuple(w)] if 0 < len(w) < n else zip(*[w[k:] for k in range(n)]))


def components(rows, n, percent):
    """{row number: (set size, least doc_id of its component)} by comparing all pairs that share a shingle."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            r = root(i)
            least[r] = min(least.get(r, d), d)
    return [(len(sets[i]), least.get(root(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
    n = len(w)
    return n, sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda d=d: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=d: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def redacted(text, spans):
    merged = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2], s[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in reversed(merged):
        text = text[:a] + f"[{kind.upper()}]" + text[b:]
    return text


def repeats(rows, width):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i : i + width] for i in range(len(b) - width + 1))
    out = []
    for _, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def collapsed(text):
    """A-Z lower-cased, runs of white space as one blank, none at the ends."""
    return " ".join(words(lower(text)))


def edits(passage, text):
    """Least edit distance of the passage to any part of the text (bytes)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        last, row = row, [i]
        for j, x in enumerate(text, 1):
            row.append(min(last[j - 1] + (x != c), last[j] + 1, row[j - 1] + 1))
    return min(row)


def base_scores(rows):
    """{row number: (held_out, n_tokens, n_known, base_score)} and N."""
    tokens = [[w.encode() for w in words(lower(t))] + [None] for _, t in rows]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 if d is not None else False for d, _ in rows]
    c = Counter(w for ts, h in zip(tokens, held) if not h for w in ts)
    total, distinct = sum(c.values()), len(c)
    out = []
    for ts, h in zip(tokens, held):
        out.append((h, len(ts), sum(c[w] > 0 for w in ts), sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in ts)))
    return out, total


CLASSES = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "\t\n\x0b\x0c\r ", ".,"


def class_shares(text):
    n = [0] * 8
    for c in text or "":
        hit = [k for k, chars in enumerate(CLASSES) if c in chars]
        n[hit[0] if hit else 6 if c in "#*$%&|<>" else 5 if c < "\x80" else 7] += 1
    total = sum(n)
    return [x / total for x in n] if total else n, total


def distance(p, q):
    def against(a, b):
        return sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x > 0)

    return math.sqrt(max(0.0, (against(p, q) + against(q, p)) / 2))


def word_limit(n, shares, deviations, least, most, long_words):
    """The largest distance of a text of ``n`` words, from the chances of all counts of each common word and of the rest."""
    without = distance([0.0] * (len(shares) - 1) + [1.0], shares)
    mean = variance = 0.0
    for p in shares if n < long_words else []:
        parts = []
        for k in range(int(n * p + 12 * math.sqrt(n * p) + 30)):
            q = k / n
            m = (p + q) / 2
            part = (p * math.log2(p / m) + (q * math.log2(q / m) if q else 0)) / 2
            parts.append((math.exp(k * math.log(n * p) - n * p - math.lgamma(k + 1)), part))
        own = sum(c * x for c, x in parts)
        mean += own
        variance += sum(c * (x - own) ** 2 for c, x in parts)
    return min(most * without, max(least * without, math.sqrt(mean + deviations * math.sqrt(variance))))


def kept_by_rules(rows, common_share, min_chars, min_words, most_class, limit):
    """doc_ids of (doc_id, text, lang) rows that the quality rules keep; every language has a reference."""
    shares, common, sizes = defaultdict(list), defaultdict(Counter), Counter()
    for _, text, lang in rows:
        p, total = class_shares(text)
        if total >= min_chars:
            shares[lang].append(p)
        w = words(lower(text))
        common[lang].update(w)
        sizes[lang] += len(w)
    refs = {}
    for lang, held in shares.items():
        mean = [sum(col) for col in zip(*held)]
        top = {w: c / sizes[lang] for w, c in common[lang].items() if c >= common_share * sizes[lang]}
        refs[lang] = ([x / sum(mean) for x in mean], top)
    kept = set()
    for d, text, lang in rows:
        n, *_, failed = counts(text)
        p, total = class_shares(text)
        reference, top = refs[lang]
        mine = Counter(w if w in top else None for w in words(lower(text)))
        far = total >= min_chars and distance(p, reference) > most_class
        if n >= min_words:
            q = [*top.values(), 1 - sum(top.values())]
            far = far or distance([mine[w] / n for w in [*top, None]], q) > limit(n, q)
        if not failed and not far:
            kept.add(d)
    return kept


def damaged(rows):
    """Rows (conv_id, turn, role, text) after the damage, and the conversations there were."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def audited(rows):
    """One conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, hash, by trying all edits in all states."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        w = words(text)
        faults.append("blank" if not w else "duplicate" if (role, text) in seen else "truncated" if w[-1][-1] not in ".!?" else None)
        seen.add((role, text))
    may = {"": "su", "s": "u", "u": "a", "a": "u"}
    known = {}

    def best(i, state, more):
        """Cost, edits and lines from row i on; ``more`` insertions may still come before it."""
        if (i, state, more) in known:
            return known[i, state, more]
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        to = "a" if state == "u" else "u"
        full = {"u": "user", "a": "assistant"}
        if more:
            c, e, x = best(i, to, more - 1)
            ways.append((c + 2, "I" + e, (full[to] + ":", *x)))
        if i < len(rows):
            _, _, role, text = rows[i]
            c, e, x = best(i + 1, state, 3)
            ways.append((c + 3, "D" + e, x))
            if faults[i] not in ("blank", "duplicate"):
                extra = int(faults[i] == "truncated")
                c, e, x = best(i + 1, to, 3)
                ways.append((c + 2 + extra, "R" + e, (f"{full[to]}:{text}", *x)))
                if role[:1] and role[:1] in may[state]:
                    c, e, x = best(i + 1, role[:1], 3)
                    ways.append((c + extra, "K" + e, (f"{role}:{text}", *x)))
        known[i, state, more] = min(ways) if ways else (10**9, "", ())
        return known[i, state, more]

    for i in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            for more in range(4):
                best(i, state, more)
    cost, audit, lines = best(0, "", 3)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


class Automaton(NamedTuple):
    words: dict[str, int]  # model words to ids from 0
    arcs: dict[int, tuple[float, int]]  # state * len(words) + word: weight and next state
    failure: list[tuple[float, int]]  # by state: weight and state; the root is 0
    after: list[int]  # by word: the state after it at the root
    to_root: list[float]  # by state: weights of all failure arcs to the root


def build_automaton(counts, n_tokens, discount):
    """States and arcs from the counts of n-grams (single words included for all words that are in longer ones)."""
    words: dict[str, int] = {}
    for g in counts:
        for w in g:
            words.setdefault(w, len(words))
    by_context: dict[tuple, list[tuple]] = {}
    for g in counts:
        if len(g) > 1:
            by_context.setdefault(g[:-1], []).append(g)
    states = {(): 0}
    for context in sorted(by_context, key=len):
        for k in range(len(context), 0, -1):
            states.setdefault(context[len(context) - k :], len(states))
    single = {w: (counts[(w,)] - discount) / n_tokens for w in words}
    mass: dict[tuple, float] = {}  # failure weight as a probability

    def probability(context: tuple, w: str) -> float:
        while context:
            if context in by_context and (*context, w) in counts:
                return (counts[(*context, w)] - discount) / counts[context]
            scale = mass.get(context, 1.0)
            return scale * probability(context[1:], w)
        return single[w]

    for context in sorted(by_context, key=len):
        kept = by_context[context]
        own = sum((counts[g] - discount) / counts[context] for g in kept)
        below = sum(probability(context[1:], g[-1]) for g in kept)
        mass[context] = max(1e-12, 1 - own) / max(1e-12, 1 - below)

    def longest(history: tuple) -> int:
        while history not in states:
            history = history[1:]
        return states[history]

    arcs = {}
    for context, kept in by_context.items():
        for g in kept:
            weight = (math.log10((counts[g] - discount) / counts[context]))
            arcs[states[context] * len(words) + words[g[-1]]] = (weight, longest(g) if len(g) < 3 else longest(g[1:]))
    failure = [(0.0, 0)] * len(states)
    for context, s in states.items():
        if context:
            failure[s] = ((math.log10(mass.get(context, 1.0))), longest(context[1:]))
    to_root = [0.0] * len(states)
    for context, s in sorted(states.items(), key=lambda x: len(x[0])):
        if context:
            to_root[s] = failure[s][0] + to_root[failure[s][1]]
    return Automaton(words, arcs, failure, [longest((w,)) for w in words], to_root)


def read(automaton, tokens, root):
    """One pass over the model words of a text (-1: not a model word) with the root weight of each token: the weight of the
    path, how many tokens took a root arc, and the state at the end."""
    arcs, failure, after, to_root, n = automaton.arcs, automaton.failure, automaton.after, automaton.to_root, len(automaton.words)
    state, total, at_root = 0, 0.0, 0
    for w, weight in zip(tokens, root):
        if w < 0:
            total += to_root[state] + weight
            at_root += 1
            state = 0
            continue
        while True:
            arc = arcs.get(state * n + w)
            if arc:
                total += arc[0]
                state = arc[1]
                break
            if not state:
                total += weight
                at_root += 1
                state = after[w]
                break
            more, state = failure[state]
            total += more
    return total, at_root, state
