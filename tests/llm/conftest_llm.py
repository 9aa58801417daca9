"""Brute-force helpers of these tests."""
import random
import re


def shingle_set(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def components_of(ids, pairs):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return [f"{r.choice('bcdfgklmnprst')}{r.choice('aeiou')}{r.randrange(vocabulary)}" for _ in range(n)]
