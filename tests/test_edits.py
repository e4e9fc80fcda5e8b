"""Scripts of edits against plain Python lists; positions after merges and membership joins."""

import random

import pytest
from conftest import in_order, plan_of

from seqloom.operators import catalog, keyed, sequence
from seqloom.operators import edits as ed
from seqloom.operators import positions as at


def by_list(values, steps):
    out = list(values)
    for kind, a, b in steps:
        if kind == "insert":
            for v in b:
                out.insert(a, v)
        elif kind == "append":
            out += b
        elif kind == "remove_at":
            if -len(out) <= a < len(out):
                out.pop(a)
        elif kind == "remove_range":
            del out[max(a, 0) : (len(out) if b is None else max(b + 1, max(a, 0)))]
        else:
            out.reverse()
    return out


def as_edit(seq, kind, a, b):
    if kind == "insert":
        return ed.Insert(a, seq(b))
    if kind == "append":
        return ed.Append(seq(b))
    if kind == "remove_range":
        return ed.RemoveRange(a, b)
    return ed.RemoveAt(a) if kind == "remove_at" else ed.Reverse()


def random_steps(rng, count):
    steps = []
    for i in range(count):
        kind = rng.choice(["insert", "insert", "append", "remove_at", "remove_at", "remove_range", "reverse"])
        index = rng.randrange(-25, 25)
        if kind in ("insert", "append"):
            steps.append((kind, index, [1000 * i + j for j in range(rng.randrange(0, 6))]))
        elif kind == "remove_range":
            steps.append((kind, index, rng.choice([None, index + 2, index + 5, index - 3]) if index > 8 else index + 2))
        else:
            steps.append((kind, index, None))
    return steps


@pytest.mark.parametrize("seed", range(6))
def test_scripts_equal_lists(seq, seed):
    rng = random.Random(seed)
    values = list(range(rng.choice([0, 1, 15])))
    steps = random_steps(rng, 12)
    got = ed.edit_script(seq(values), [as_edit(seq, *s) for s in steps])
    assert in_order(got) == by_list(values, steps)


def test_composition_equals_lists():
    """Many scripts on the table of runs alone."""
    for seed in range(300):
        rng = random.Random(seed)
        values, steps = list(range(rng.randrange(0, 20))), random_steps(rng, 25)
        sources = [values, *[b for kind, _, b in steps if kind in ("insert", "append")]]
        runs = ed.composed(len(values), [as_edit(lambda v: v, *s) for s in steps], [len(s) for s in sources[1:]])
        out = []
        for r in runs.runs:
            part = sources[r.source][r.start : r.start + r.length]
            out += part[::-1] if r.backwards else part
        assert out == by_list(values, steps) and runs.length == len(out)


def test_strict_removal(seq):
    with pytest.raises(IndexError):
        ed.edit_script(seq([1, 2]), [ed.RemoveAt(0), ed.RemoveAt(1, strict=True)])


def test_one_scan_whatever_the_number_of_edits(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey AS v", "o_orderkey AS _pos")
    plan = plan_of(ed.edit_script(orders, [ed.RemoveAt(i) for i in range(40)]))
    assert plan.count("FileScan") == 1 and "NestedLoop" not in plan


def test_merges_and_membership_joins_note_their_gaps(spark, seq):
    stored = seq(["a", "b"], "string", "k")
    merged = keyed.upsert_first_wins(stored, seq(["a", "c", "d"], "string", "k"), "k")
    assert in_order(at.reverse(merged), "k") == ["d", "c", "b", "a"]
    assert [r.k for r in at.element_at(merged, 2).collect()] == ["c"]
    letters, some = seq(list("abcdef"), "string", "k"), seq(["b", "e", "f"], "string", "k")
    assert in_order(at.reverse(catalog.semi_members(letters, some, "k")), "k") == ["f", "e", "b"]
    assert in_order(at.reverse(catalog.new_only(letters, some, "k")), "k") == ["d", "c", "a"]
    assert in_order(at.reverse(catalog.children_of(letters, "k", "e")), "k") == ["e"]
    assert in_order(at.reverse(catalog.children_of_many(letters, "k", some.select("k"))), "k") == ["f", "e", "b"]
    replaced = catalog.replace_children(letters, some, seq(["x", "y"], "string", "k"), "k")
    assert in_order(at.reverse(replaced), "k") == ["y", "x", "d", "c", "a"]
    known, unknown = sequence.split_on_null(seq([None, 1, None, 2]), "v")
    assert in_order(at.reverse(known)) == [2, 1] and in_order(at.reverse(unknown)) == [None, None]
