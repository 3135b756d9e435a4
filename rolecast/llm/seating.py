"""Tables of words in the restaurants of a hierarchical Pitman-Yor model.

A customer at a restaurant is a word; each of its tables is a customer of the parent. All
tables of a word are seated together, while the number of tables of whole restaurants is
known from the sweep before."""

from __future__ import annotations

import numpy as np

LEVELS = 3  # no word before, one, two
STRENGTH = 1.0
#: Customers of a word that are seated one by one; later ones in groups that double.
SINGLY = 16


def table_weights(discount: float) -> list[np.ndarray]:
    """For c = 0 .. SINGLY customers: weights of t = 0 .. c tables, before the weight of a
    new table (generalised Stirling numbers, each row scaled to a maximum of one)."""
    rows = [np.array([1.0])]
    for c in range(SINGLY):
        stay = np.append(rows[-1] * np.maximum(c - discount * np.arange(c + 1), 0), 0)
        new = np.append(0, rows[-1])
        rows.append((stay + new) / (stay + new).max())
    return rows


def draw_tables(customers: np.ndarray, new: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """Tables of words with so many customers, `new` being the weight of a new table.

    Up to SINGLY customers, a draw from the exact distribution; further ones join or open
    tables in groups that double, at the odds in the middle of the group."""
    few, tables = np.minimum(customers, SINGLY), np.zeros(len(customers), np.int64)
    for c, weights in enumerate(table_weights(discount)):
        at = np.flatnonzero(few == c)
        if c < 2 or not len(at):
            tables[at] = c
            continue
        powers = np.log(weights[1:])[:, None] + np.arange(1, c + 1)[:, None] * np.log(new[at])
        chances = np.cumsum(np.exp(powers - powers.max(axis=0)), axis=0)
        tables[at] = 1 + (chances < draw.random(len(at)) * chances[-1]).sum(axis=0)
    done = few.copy()
    at = np.flatnonzero(done < customers)
    while len(at):
        group = np.minimum(done[at], customers[at] - done[at])
        seated = done[at] + group / 2 - discount * tables[at]
        tables[at] += draw.binomial(group, new[at] / (new[at] + np.maximum(seated, 1e-9)))
        done[at] += group
        at = at[done[at] < customers[at]]
    return tables
