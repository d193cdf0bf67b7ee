"""Plain versions of the operators, one row at a time, for comparison."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def fingerprint(text, k=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius=2):
    """Smallest position reachable for each of the fingerprints."""
    values = np.array(prints, np.uint64)
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius):
            a, b = find(i), find(int(j))
            group[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def matches(pattern, text, keep=lambda m: True, flags=0):
    return [(m.start(), m.end()) for m in re.finditer(pattern, text, flags) if keep(m)]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(m):
    return re.sub("[^0-9]", "", m[0])


def pii_spans(text):
    found = {
        "email": matches(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
        "ip": matches(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": matches(r"[0-9]([\x20-]?[0-9])+", text, lambda m: 16 <= len(digits_of(m)) <= 19 and luhn(digits_of(m))),
        "phone": matches(r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 8 <= len(digits_of(m)) <= 15),
    }
    return [(k, a, b) for k in found for a, b in found[k]]


def secret_spans(text):
    assign = r"(?a:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = {
        "assign": matches(assign, text, lambda m: len(m[2]) >= 12 and m[1].isascii(), re.I),
        "access": matches(r"AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 18),
        "hex": matches(r"[0-9a-f]+", text, lambda m: len(m[0]) >= 16),
    }
    order = list(found)
    return sorted(((k, a, b) for k in found for a, b in found[k]), key=lambda s: (s[1], order.index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def quality_counts(text):
    words = WORD.findall(text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": duplicates,
        "n_repeat_words": len(repeated),
    }


def least_capacity(sizes, shards):
    """Smallest capacity of greedy filling, by trying prefix sums."""
    def needed(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used

    low, high = max(sizes, default=1), max(1, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        if needed(middle) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def targets(sizes, weights, most=3):
    total, out, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        for i in free:
            out[i] = rest * weights[i] / sum(weights[j] for j in free)
        over = {i for i in free if out[i] > most * sizes[i]}
        if not over:
            return out
        for i in over:
            out[i] = most * sizes[i]
        free -= over


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def within(a, b, most):
    """Whether the edit distance is at most ``most``: a column of the table as bits (Myers)."""
    if not a or not b:
        return max(len(a), len(b)) <= most
    where, mask, score = defaultdict(int), (1 << len(a)) - 1, len(a)
    for i, x in enumerate(a):
        where[x] |= 1 << i
    up, down, last = mask, 0, 1 << len(a) - 1
    for left, x in zip(range(len(b) - 1, -1, -1), b):
        same = where.get(x, 0)
        across = (((same & up) + up) ^ up) | same
        rise, fall = down | ~(across | up), up & across
        score += bool(rise & last) - bool(fall & last)
        if score - left > most:
            return False
        rise, fall = rise << 1 | 1, fall << 1
        up, down = (fall | ~(same | down | rise)) & mask, rise & (same | down) & mask
    return score <= most


def normal_line(line):
    plain = re.sub(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", line.lower())
    return re.sub(r"[0-9]+", "0", plain).strip(" ")


def similar_pairs(lines, least=0.8):
    """All pairs i > j of lines with edit similarity ``least``. An edit changes the counts of
    grams of n characters by 2 n at most, so pairs whose counts differ in more are not alike."""
    grams = [[Counter(x[i : i + n] for i in range(len(x) - n + 1)) for x in lines] for n in (3, 4)]
    two = np.zeros((len(lines), 256), np.int32)
    for row, line in zip(two, lines):
        for i in range(len(line) - 1):
            row[zlib.crc32(line[i : i + 2].encode("utf-8", "surrogatepass")) % 256] += 1
    sizes = np.array([len(x) for x in lines])
    for i in range(1, len(lines)):
        most = ((1 - least) * np.maximum(sizes[:i], sizes[i]) + 1e-9).astype(int)
        near = np.flatnonzero(np.abs(sizes[:i] - sizes[i]) <= most)
        near = near[np.abs(two[near] - two[i]).sum(axis=1) <= 4 * most[near]]
        for j in near.tolist():
            apart = [c[i].total() + c[j].total() - 2 * sum(min(k, c[j][g]) for g, k in c[i].items() if g in c[j]) for c in grams]
            if apart[0] <= 6 * most[j] and apart[1] <= 8 * most[j] and within(lines[i], lines[j], int(most[j])):
                yield i, j


def removed_lines(docs, least=0.8, min_chars=9):
    """{(doc_id, text): removed line numbers} of distinct (id, text) documents."""
    places = defaultdict(list)
    for doc_id, text in {(i, t or "") for i, t in docs}:
        for n, line in enumerate(text.split("\n")):
            line = normal_line(line)
            if line:
                key = (doc_id is None, doc_id or 0, hashlib.md5(text.encode()).hexdigest(), n)
                places[line].append((key, (doc_id, text), n))
    lines = sorted(places, key=lambda line: min(places[line])[0])
    group = list(range(len(lines)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    long = [i for i, line in enumerate(lines) if len(line) >= min_chars]
    for i, j in similar_pairs([lines[i] for i in long], least):
        a, b = find(long[i]), find(long[j])
        group[max(a, b)] = min(a, b)
    out = defaultdict(set)
    members = defaultdict(list)
    for i, line in enumerate(lines):
        members[find(i)] += places[line]
    for all_places in members.values():
        for _, doc, n in sorted(all_places, key=lambda p: p[0])[1:]:
            out[doc].add(n)
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def damage(rows):
    """``(conv_id, turn, role, text)`` rows after damage, missing values as one space."""
    out = []
    for conv_id, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv_id, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def repaired(rows):
    """Cheapest edits of one conversation's ``(role, text, fault)`` rows: least (cost, letters) over all.

    Works from the last row on: (cost, letters, repaired rows) of what is left, by row and state of
    the roles so far, with letters as plain strings.
    """
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    best = {(len(rows), s): (0, "", ()) for s in (0, 3)}
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            role, text, fault = rows[i]
            stays = 5 if fault == "truncated" else 0
            for s in range(4):
                ways = []
                edits = [(2, "D", s, None)]
                if fault not in ("blank", "duplicate"):
                    edits.append((stays, "K", step.get((s, role[:1])), role))
                    edits += [(1 + stays, "R", step.get((s, r[0])), r) for r in ("user", "assistant")]
                for cost, letter, to, name in edits:
                    if (i + 1, to) in best:
                        c, l, kept = best[i + 1, to]
                        ways.append((c + cost, letter + l, ((name, text), *kept) if name else kept))
                if ways:
                    best[i, s] = min(ways)
        for _ in range(4):  # inserts before row i
            for s in range(4):
                ways = [best[i, s]] if (i, s) in best else []
                for name in ("user", "assistant"):
                    to = step.get((s, name[0]))
                    if (i, to) in best:
                        c, l, kept = best[i, to]
                        ways.append((c + 5, "I" + l, ((name, ""), *kept)))
                if ways:
                    best[i, s] = min(ways)
    return best[0, 0]


def conversation(conv_id, rows):
    """Report of one conversation's damaged ``(turn, role, text)`` rows."""
    own = "\1" if conv_id is None else conv_id
    key = [(t is not None, t or 0, r, sha(f"{own}\0{r}\0{x}")) for t, r, x in rows]
    rows = [r for _, r in sorted(zip(key, rows), key=lambda pair: pair[0])]
    seen, judged = set(), []
    for _, role, text in rows:
        last = text.strip(" \t\n\v\f\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    pairs = zip(judged, judged[1:])
    cost, audit, kept = repaired(judged)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": sum(f == "blank" for *_, f in judged),
        "duplicate": sum(f == "duplicate" for *_, f in judged),
        "truncated": sum(f == "truncated" for *_, f in judged),
        "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": sha("\n".join(f"{r}:{t}" for r, t in kept)),
    }


def spelling_words(rows):
    """Counts of the words of ``(doc_id, text)`` rows."""
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(counts):
    """``word -> (form, root, n, n_near, form_n)`` by comparing all words."""
    by_length = defaultdict(list)
    for word in counts:
        by_length[len(word)].append(word)
    near = {}
    for word in counts:
        others = [o for k in (-1, 0, 1) for o in by_length[len(word) + k]]
        near[word] = [o for o in others if one_edit(word, o)]
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best and counts[best] >= 5 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        out[word] = (form[word], root, n, len(near[word]), counts.get(form[word]))
    return out
