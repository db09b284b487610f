"""Plans in order, against runs that are played file by file."""

import random

import pytest

from sampleledger.plans import ordering


def play_moves(plan, paths):
    """Moves by step; none may overwrite. What stays must have had a reason to."""
    here = set(paths)
    for p in sorted((p for p in plan if p["action"] == "move"), key=lambda p: p["step"]):
        assert p["path"] in here and p["newpath"] not in here, p
        here = here - {p["path"]} | {p["newpath"]}
    return here


@pytest.mark.parametrize("seed", range(3))
def test_no_move_overwrites_a_file(spark, seed):
    rng = random.Random(seed)
    paths = [f"d/{i}" for i in range(120)]
    targets = [f"d/{i}" for i in range(150)]
    wanted = [(p, rng.choice(targets) if seed else targets[i + 1]) for i, p in enumerate(paths) if rng.random() < 0.9]
    cycle = [(f"c/{i}", f"c/{(i + 1) % 7}") for i in range(7)] + [("e/1", "e/1"), ("f/1", "f/2"), ("f/1", "f/3")]
    every = paths + [a for a, _ in cycle]
    plan = ordering.order_moves(
        spark.createDataFrame(wanted + cycle, "path string, newpath string"), spark.createDataFrame([(p,) for p in every], "path string")
    ).collect()
    assert len(plan) == len({a for a, _ in wanted + cycle})
    here = play_moves(plan, every)
    of = {p["path"]: p for p in plan}
    assert all(of[f"c/{i}"]["action"] == "cycle" for i in range(7)) and of["e/1"]["action"] == "same" and of["f/1"]["newpath"] == "f/2"
    moving = {p["path"]: p["newpath"] for p in plan if p["action"] in ("move", "exists", "cycle")}
    for p in plan:
        if p["action"] == "exists":  # the target is there to the end, and is no part of a cycle
            assert p["newpath"] in here and of.get(p["newpath"], {"action": "exists"})["action"] in ("exists", "clash", "same")
        if p["action"] == "clash":
            assert any(a < p["path"] and b == p["newpath"] for a, b in moving.items())
        if p["action"] == "cycle":
            at, seen = p["newpath"], 0
            while at != p["path"] and seen < 200:
                at, seen = moving[at], seen + 1
            assert at == p["path"]


def test_moves_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(ordering, "kept", lambda df, keep=ordering.kept: rounds.append(1) or keep(df))
    n = 1000
    moves = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(n)], "path string, newpath string")
    plan = ordering.order_moves(moves, moves.select("path")).collect()
    assert {int(p["path"]): p["step"] for p in plan} == {i: n - i for i in range(n)}
    assert len(rounds) <= 13


def play_mappings(names, mapping):
    """The run of one directory, as a script makes it."""
    here, origin, out = set(names), {n: n for n in names}, []
    stopped = False
    for seq, old, new in mapping:
        new = "".join((new or "").split())
        if not old or not new:
            continue
        for name in sorted(n for n in here if old in n):
            to = name.replace(old, new)
            if to in here:
                return out, (origin[name], seq, name, to)
            here = here - {name} | {to}
            out.append((origin[name], seq, name, to))
            origin[to] = origin.pop(name)
    return out, None


@pytest.mark.parametrize("seed", range(5))
def test_mappings_in_order(spark, seed):
    rng = random.Random(seed)
    dirs = {d: sorted({"".join(rng.choices("abcd", k=rng.randint(2, 5))) + f"_{i if d == 'one' else i % 9}" for i in range(25)}) for d in ("one", "two", "three")}
    ids = ["".join(rng.choices("abcdxy", k=rng.randint(1, 3))) for _ in range(24)]
    mapping = [(i, rng.choice(ids), rng.choice(ids) + f"{i}" * (seed < 3) + rng.choice(["", " "])) for i in range(14)] + [(20, "", "q"), (21, "a", " "), (22, None, "z")]
    files = [(d, n, f"{d}/{n}") for d, names in dirs.items() for n in names]
    found = ordering.rename_in_order(
        spark.createDataFrame(files, "dir string, file string, path string"), spark.createDataFrame(mapping, "seq long, old_id string, new_id string")
    ).collect()
    for d, names in dirs.items():
        made, conflict = play_mappings(names, mapping)
        mine = [r for r in found if r["path"].startswith(d + "/")]
        assert sorted((r["path"][len(d) + 1:], r["seq"], r["name"], r["newname"]) for r in mine if r["action"] == "rename") == sorted(made)
        stop = [(r["path"][len(d) + 1:], r["seq"], r["name"], r["newname"]) for r in mine if r["action"] == "conflict"]
        assert stop == ([conflict] if conflict else [])
        if not conflict:
            assert all(r["action"] == "rename" for r in mine)


def test_mappings_that_fit_nothing(spark):
    files = spark.createDataFrame([("d", "a", "d/a")], "dir string, file string, path string")
    assert ordering.rename_in_order(files, spark.createDataFrame([(1, "b", "c")], "seq long, old_id string, new_id string")).count() == 0
