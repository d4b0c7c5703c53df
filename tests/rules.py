"""Plain forms of rules, for comparison."""


def pairs(events):
    """events: set of (time, 1 for an OUT, truck). IN -> its truck, the first OUT that has it as its latest IN and that one's truck; of equal
    times the least truck."""
    found, last = {}, None
    for t, out, truck in sorted(events, key=lambda e: (e[0], e[1], e[2] is None, e[2] or "")):
        if not out and t not in found:
            last = t
            found[t] = (truck, None, None)
        elif out and last is not None and found[last][1] is None:
            found[last] = (found[last][0], t, truck)
    return found
