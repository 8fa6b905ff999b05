import functools
import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonalis.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def by_enumeration(rows):
    """Cheapest (cost, audit) and rows over all edit sequences with at most two inserts in a row."""

    def prefixes(roles):
        return re.fullmatch(r"(s?(ua)*u?)?", roles)

    @functools.cache
    def best(at, roles, inserts):
        found = []
        if at == len(rows):
            if GRAMMAR.fullmatch(roles):
                found.append((0, "", ()))
        else:
            role, text, fault = rows[at]
            cost, audit, kept = best(at + 1, roles, 0)
            found.append((cost + 2, "D" + audit, kept))
            if fault not in ("blank", "duplicate"):
                for edit, new, price in [("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)]:
                    if prefixes(roles + new[:1]) and new[:1]:
                        cost, audit, kept = best(at + 1, roles + new[:1], 0)
                        found.append((cost + price + 5 * (fault == "truncated"), edit + audit, ((new, text), *kept)))
        if inserts < 2:
            for new in ("user", "assistant"):
                if prefixes(roles + new[0]):
                    cost, audit, kept = best(at, roles + new[0], inserts + 1)
                    found.append((cost + 5, "I" + audit, ((new, ""), *kept)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def symbol(role, fault):
    if fault in ("blank", "duplicate"):
        return "d"
    own = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return own.upper() if fault == "truncated" else own


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "uncle"]), st.just("t"),
                st.sampled_from(["none", "none", "truncated", "blank", "duplicate"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ROW, max_size=7), max_size=6))
def test_cheapest_and_least_audits(conversations):
    automaton = repair.Automaton()
    signed = {"".join(symbol(r, f) for r, _, f in rows): rows for rows in conversations}
    for signature in sorted(signed, key=lambda s: s[::-1]):
        automaton.load(signature)
        cost, audit, _ = by_enumeration(tuple(signed[signature]))
        assert automaton.best() == (cost, audit)
    suffixes = {s[i:] for s in signed for i in range(len(s))}
    assert automaton.made == len(suffixes)  # a node per distinct suffix


def test_long_signature():
    automaton = repair.Automaton()
    automaton.load("ua" * 200_000 + "u")
    assert automaton.best() == (2, "K" * 400_000 + "D")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not own else "duplicate" if (role, text) in seen else
                   "none" if own[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plainly(rows):
    """The contract for one conversation: rows of (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    said = [r[1:] for r in rows]
    faults = faults_of(said)
    cost, audit, kept = by_enumeration(tuple((r, x, f) for (r, x), f in zip(said, faults, strict=True)))
    turns = [t for t, _, _ in rows if t is not None]
    text = "\n".join(f"{r}:{x}" for r, x in kept)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
    }


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"), (1, 4, "user", "So"),
    (2, None, "system", "Be kind."), (2, 0, "assistant", "I am."), (2, 3, None, "x."), (2, 3, "user", None),
    (3, 0, "user", ""), (3, 1, "user", " \n"),
    (None, 5, "user", "a?"), (None, 6, "assistant", "b. \t"),
    (4, None, "tool", "x"), (4, None, "", "y."),
    (5, 0, "user", "w " * 30000 + "."), (5, 1, "assistant", "."), (5, 2, "user", "."), (5, 3, "assistant", "."),
    (6, 7, "user", "Tail.\x0b"), (6, 8, "user", "Tail.\x0b"), (6, 9, "assistant", "é\x85"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "mine", 1) for r in ODD],
                               "conv_id bigint, turn bigint, role string, text string, audit string, `a.b` int")
    signed = repair.signatures(df)
    plans = repair.plan_repairs(signed)
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.digests(repair.apply_repairs(df, plans)).collect()}
    rows = {r.conv_id: r.asDict() | {"repaired_sha256": hashes[r.conv_id]} for r in plans.collect()}
    for conv in {r[0] for r in ODD}:
        want = plainly([r[1:] for r in ODD if r[0] == conv])
        assert {k: rows[conv][k] for k in want} == want, conv
    edits = repair.apply_repairs(df, plans).where("conv_id = 3").collect()
    assert [(e.place, e.edit, e.role, e.text) for e in edits] == [(0, "D", None, None), (1, "D", None, None)]
    none = df.limit(0)
    assert repair.signatures(none).count() == 0
    assert repair.apply_repairs(none, repair.plan_repairs(repair.signatures(none))).count() == 0


def test_repairing_again_costs_nothing(spark):
    df = spark.createDataFrame([r for r in ODD if r[0] in (1, 2, 4, 5)], "conv_id bigint, turn bigint, role string, text string")
    edits = repair.apply_repairs(df, repair.plan_repairs(repair.signatures(df)))
    kept = edits.where("edit != 'D'").selectExpr("conv_id", "place AS turn", "role", "if(text = '', 'filled.', text) AS text")
    again = repair.plan_repairs(repair.signatures(kept)).where("blank + duplicate + truncated = 0").collect()
    assert again and all(set(r.audit) == {"K"} and r.cost == 0 for r in again)


def damaged(row):
    code = zlib.crc32(f"{row.conv_id}:{row.turn}".encode()) % 20
    role, text = "user" if code == 4 else row.role, "" if code == 1 else row.text
    text = re.sub("[.!?]", "", text) if code == 2 else text
    return [(row.turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)


def test_query(spark, sf_small):
    original, kept = {}, {}
    for row in spark.read.parquet(f"{sf_small}/conversations.parquet").collect():
        original[row.conv_id] = True
        kept.setdefault(row.conv_id, []).extend(damaged(row))
    rows = {r.conv_id: r.asDict() for r in repair.op12_repair(spark, sf_small).collect()}
    assert set(rows) == set(original)
    for conv, got in rows.items():
        want = plainly(kept[conv])
        assert {k: got[k] for k in want} == want
