import random

import pytest

from millrace.llm import defects


def altered(n, share, seed):
    r = random.Random(seed)
    pool = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(1500)]
    q = [r.choice(pool) for _ in range(n)]
    a = list(q)
    for i in r.sample(range(n), round(n * share)):
        a[i] = r.choice(pool)
    return " ".join(q), "You asked: " + " ".join(a), " ".join(r.choice(pool) for _ in range(n))


@pytest.mark.parametrize("n", [120, 250, 1000, 4000])
def test_long_copies(n):
    for seed in range(5):
        q, a, other = altered(n, 0.02, seed)
        assert defects.is_copy(q, a)
        assert not defects.is_copy(q, other) and not defects.is_copy(q, altered(n, 0.3, seed)[1])
        assert not defects.is_copy(q, a + " " + other)
    assert not defects.is_copy("the hares eat grass in spring " * n, "some foxes wait for rain and leave soon " * n)
