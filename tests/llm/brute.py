"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

WHITE = " \t\n\r\x0b\x0c"


def words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in (text or "") + " ":
        if c in WHITE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text: str | None, each: int) -> set[tuple[str, ...]]:
    w = words(lower(text))
    return {tuple(w[i : i + each]) for i in range(max(1, len(w) - each + 1))} if w else set()


def near_components(rows: list[tuple[int, str | None]], each: int) -> dict[int, tuple[int, int]]:
    """id → (set size, smallest id reachable by links of 80 of 100 parts or more)."""
    sets = {i: shingles(text, each) for i, text in rows}
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The remaining capacities of all bins."""
    bins: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [(left, i) for i, left in enumerate(bins) if left >= length]
        if fits:
            bins[min(fits)[1]] -= length
        else:
            bins.append(capacity - length)
    return bins


def repeated(doc: list, window: int, at_least: int) -> tuple[int, int, int]:
    """Words in repeated windows, words in repeats of at_least or more words, and the longest repeat."""
    n = len(doc)

    def common(i: int, j: int) -> int:
        k = 0
        while i + k < n and j + k < n and doc[i + k] == doc[j + k]:
            k += 1
        return k

    longest = [max((common(i, j) for j in range(n) if j != i), default=0) for i in range(n)]
    in_window = {i + k for i, m in enumerate(longest) if m >= window for k in range(window)}
    in_repeat = {i + k for i, m in enumerate(longest) if m >= at_least for k in range(m)}
    return len(in_window), len(in_repeat), max(longest, default=0)
