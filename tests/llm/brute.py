"""Brute-force versions of what the operators compute."""

DOCS = "/root/testdata/sf0.001"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(rows):
    """The distinct five-word shingles of each document."""
    found = {}
    for i, text in rows:
        words = (text or "").encode().translate(LOWER).split()
        found[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return found


def brute_components(sets):
    """The smallest id that each document reaches over links of 75 percent."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}
