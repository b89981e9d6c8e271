"""Subtree sums over a forest by centroid decomposition.

A component is a connected part of a tree with its top. Its centroid is a node whose removal
leaves parts of at most half the weight. What lies below the centroid inside the component is
summed once and added to every node on the path from the centroid up to the top; then the
centroid goes, and the parts, each child's and the upper one, are components of their own. A
node and one below it are parted by exactly one centroid on the path between them, so each
pair is counted once, and every node is in a number of components that grows with the
logarithm of the weight, however deep the tree is.
"""

from __future__ import annotations


def subtree_sums(parents: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """For each node of a forest the sum of the values below it, its own included.

    ``parents`` holds the place of each node's parent, or -1.
    """
    n = len(parents)
    width = len(values[0]) if values else 0
    children: list[list[int]] = [[] for _ in range(n)]
    for node, parent in enumerate(parents):
        if parent >= 0:
            children[parent].append(node)
    sums = [[0] * width for _ in range(n)]
    gone = [False] * n
    size = [0] * n
    tops = [node for node in range(n) if parents[node] < 0]
    while tops:
        top = tops.pop()
        component, todo = [], [top]
        while todo:
            node = todo.pop()
            component.append(node)
            # children that have gone are not looked at again
            children[node] = own = [x for x in children[node] if not gone[x]]
            todo.extend(own)
        for node in reversed(component):
            size[node] = 1 + sum(size[x] for x in children[node])
        centroid, half = top, len(component) // 2
        while True:
            heavy = next((x for x in children[centroid] if size[x] > half), None)
            if heavy is None:
                break
            centroid = heavy
        total, todo = [0] * width, [centroid]
        while todo:
            node = todo.pop()
            for i, value in enumerate(values[node]):
                total[i] += value
            todo.extend(children[node])
        node = centroid
        while True:
            for i, value in enumerate(total):
                sums[node][i] += value
            if node == top:
                break
            node = parents[node]
        gone[centroid] = True
        tops.extend(children[centroid])
        if centroid != top:
            tops.append(top)
    return sums
