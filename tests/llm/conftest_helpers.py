"""Plain helpers of the brute-force versions."""


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def unite(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
