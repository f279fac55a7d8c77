"""Plain versions of what the operators compute, for small inputs."""

import re


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    ws = [w for w in re.split("[\x20\x09-\x0D]+", fold(text)) if w]
    if not ws:
        return frozenset()
    if len(ws) < width:
        return frozenset([tuple(ws)])
    return frozenset(tuple(ws[k:k + width]) for k in range(len(ws) - width + 1))


def labels(n, links):
    low = list(range(n))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        low[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def near_components(docs, width, percent=80):
    """{id: (set size, least id reachable)} of (id, text) rows with distinct ids."""
    docs = sorted(docs, key=lambda d: d[0])
    sets = [shingles(t, width) for _, t in docs]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                k = len(a & b)
                if 100 * k >= percent * (len(a) + len(b) - k):
                    links.append((i, j))
    low = labels(len(docs), links)
    return {d[0]: (len(sets[i]), docs[low[i]][0]) for i, d in enumerate(docs)}


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def benchmark_hits(text, items, window):
    """(words, hit positions, items) by comparing every window with every position."""
    ws = WORD.findall(fold(text))
    hit, found = set(), set()
    for item, t in items:
        iw = WORD.findall(fold(t))
        for k in range(max(1, len(iw) - window + 1)) if iw else ():
            w = iw[k:k + window]
            for p in range(len(ws) - len(w) + 1):
                if ws[p:p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    found.add(str(item))
    return ws, hit, found


def luhn(digits):
    x = [int(c) for c in digits][::-1]
    return (sum(x[0::2]) + sum(sum(divmod(2 * d, 10)) for d in x[1::2])) % 10 == 0


def personal_data(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out
