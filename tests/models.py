"""Plain models of the rules for small inputs, stated by positions and orders
rather than by the way an engine would walk through them."""

from __future__ import annotations

import re
from itertools import accumulate, groupby


def chunk_loop(tokens, min_len, max_len, target):
    """A text up to max_len is one chunk; else the windows of target tokens at every
    multiple of target // 2, up to the first that reaches the end; short ones go."""
    n = len(tokens)
    if n <= max_len:
        return [list(tokens)] * (n >= min_len)
    starts = range(0, n, target // 2)
    reaching = min(s for s in starts if s + target >= n)
    return [list(tokens[s:s + target]) for s in starts if s <= reaching and min(target, n - s) >= min_len]


def pairs_loop(chunk, seq_len):
    """Positions fall into groups of seq_len; a group counts if the token after it exists."""
    groups = [[i for _, i in g] for _, g in groupby(((i // seq_len, i) for i in range(len(chunk))), key=lambda x: x[0])]
    whole = [g for g in groups if len(g) == seq_len and g[-1] + 1 < len(chunk)]
    return [([chunk[i] for i in g], [chunk[i + 1] for i in g]) for g in whole]


def windows_loop(flat, seq_len, stride=None):
    """All windows that fit, by start; labels are the next tokens, as far as there are any."""
    fitting = [s for s in range(len(flat)) if s % (stride or seq_len) == 0 and s + seq_len <= len(flat)]
    return [([flat[i] for i in range(s, s + seq_len)], [flat[i + 1] for i in range(s, s + seq_len) if i + 1 < len(flat)]) for s in fitting]


def budget_loop(lengths, target):
    """What starts below the target stays; no target keeps all."""
    before = [0, *accumulate(lengths)]
    return [n for n, b in zip(lengths, before) if not target or b < target]


def checkpoint_loop(names):
    """The last by (is the latest, step, reversed name order); a step that isn't a number is 0."""
    ranked = []
    for n in names:
        m = re.fullmatch(r"checkpoint_step_(.*)\.pt", n)
        if n == "latest.pt" or m:
            tail = m[1].rpartition("_")[2] if m else ""
            ranked.append((n == "latest.pt", int(tail) if tail.isdigit() else 0, [-ord(c) for c in n], n))
    return max(ranked)[-1] if ranked else None


def monitor_loop(batches):
    """A poll's last row shows if its step is above all shown before (above 0 at first);
    arrows compare it with the row shown before, a null now counting as 0."""
    newest = [rows[-1] for rows in batches if rows]
    highest = [0, *accumulate((r.get("step", 0) for r in newest), lambda a, b: max(a, b, 0))]
    rows = [r for r, h in zip(newest, highest) if r.get("step", 0) > h]
    sign = {-1: "↓", 0: "→", 1: "↑"}
    out = []
    for old, new in zip([{}, *rows], rows):
        out.append((new["step"], {m: "" if old.get(m) is None else sign[((new.get(m) or 0.0) > old[m]) - ((new.get(m) or 0.0) < old[m])]
                                  for m in ("loss", "perplexity", "tokens_per_second")}))
    return out
