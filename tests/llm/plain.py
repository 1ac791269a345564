"""Plain versions that several tests hold operators to."""


def plain_kept(data):
    """Least ids of the classes, by all pairs."""

    def shingled(text):
        words = (text or "").encode().lower().split()
        return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingled(t) for _, t, _ in data]
    group = list(range(len(data)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(data)):
        for b in range(a):
            if sets[a] == sets[b] or (sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
                group[root(a)] = root(b)
    least: dict = {}
    for k, (i, _, _) in enumerate(data):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(least.values())
