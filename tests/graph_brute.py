"""Plain-Python twins used as test oracles for the graph operators (small graphs only)."""

from __future__ import annotations

from collections import defaultdict, deque


def adjacency(pairs):
    adj = defaultdict(set)
    for a, b in pairs:
        if a != b:
            adj[a].add(b)
            adj[b].add(a)
    return adj


def components(adj, removed=None):
    seen, count = set(), 0
    for s in adj:
        if s == removed or s in seen:
            continue
        count += 1
        seen.add(s)
        q = deque([s])
        while q:
            x = q.popleft()
            for y in adj[x]:
                if y != removed and y not in seen:
                    seen.add(y)
                    q.append(y)
    return count


def cut_vertices(pairs):
    """Brute force: v is a cut vertex when removing it raises the component count."""
    adj = adjacency(pairs)
    base = components(adj)
    return {v for v in adj if components(adj, removed=v) > base}


def bfs_dist(adj, s):
    d = {s: 0}
    q = deque([s])
    while q:
        x = q.popleft()
        for y in adj[x]:
            if y not in d:
                d[y] = d[x] + 1
                q.append(y)
    return d
