"""op4 over texts of very many notices, and its row-wise alignment against a table filled cell
by cell."""

import random
import time

import numpy as np
import pytest

from txmart.llm import op04_license_scan as op4


def by_cells(template, words, diagonal, band):
    """Places matched by the best alignment, cell by cell; a match is preferred to a template
    word left out, that to a document word left out, and an earlier end to a later one."""
    best = {}
    for i in range(len(template) + 1):
        for j in range(max(0, diagonal - band + i), min(len(words), diagonal + band + i) + 1):
            ways = [(0, ())] if i == 0 else []
            if i and j and template[i - 1] == words[j - 1] and (i - 1, j - 1) in best:
                ways.append((best[i - 1, j - 1][0] + 2, (*best[i - 1, j - 1][1], j - 1)))
            ways += [(best[at][0] - 1, best[at][1]) for at in ((i - 1, j), (i, j - 1)) if at in best]
            if ways:
                best[i, j] = max(ways, key=lambda w: w[0])
    ends = [best[i, j] for i, j in sorted(best) if i == len(template)]
    return list(max(ends, key=lambda w: w[0])[1]) if ends else []


@pytest.mark.parametrize("seed", range(200))
def test_alignment_equals_a_table_filled_cell_by_cell(seed):
    rng = random.Random(seed)
    template = np.array([rng.randrange(6) for _ in range(rng.randint(1, 9))], dtype=np.uint64)
    words = np.array([rng.randrange(6) for _ in range(rng.randint(0, 25))], dtype=np.uint64)
    if rng.random() < 0.5:
        words = np.concatenate([words[:7], template, words[7:]])
    diagonal, band = rng.randint(-6, len(words) + 3), rng.randint(0, 5)
    assert op4.align(template, words, diagonal, band) == by_cells(template.tolist(), words.tolist(), diagonal, band)


def test_thousands_of_notices_in_one_text():
    names = ["MIT", "Apache-2.0", "GPL-2.0", "CC-BY-4.0"]
    index = op4.Index(op4.TEMPLATES.items())
    lines = [f"{op4.TEMPLATES[names[k % 4]]} word{k}\n" for k in range(6000)]
    text = "".join(lines)
    begun = time.time()
    got = op4.scan_text(index, text)
    assert time.time() - begun < 120
    ends = np.cumsum([0, *map(len, lines)])
    assert [n for _, _, n, _ in got] == [names[k % 4] for k in range(6000)]
    assert [(a, share) for a, _, _, share in got] == [(int(x), 1.0) for x in ends[:-1]]
