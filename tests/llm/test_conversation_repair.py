"""Conversation repair against an exhaustive search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

from chartstreak.llm import conversation_repair as cr

GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def all_edits(rows):
    """Every (cost, audit, lines) of the faulted rows with at most two insertions at each place."""
    fills = [()] + [((r,) * n) for r in ("user", "assistant") for n in (1,)] + [
        ("user", "assistant"), ("assistant", "user")]

    def options(role, text, fault):
        out = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            out += [(extra, "K", (role, text)), (1 + extra, "R", ("user", text)), (1 + extra, "R", ("assistant", text))]
        return out
    for chosen in itertools.product(*[options(*r) for r in rows]):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for n, gap in enumerate(gaps):
                for role in gap:
                    cost, audit = cost + 5, audit + "I"
                    lines.append((role, ""))
                if n < len(rows):
                    cost, audit = cost + chosen[n][0], audit + chosen[n][1]
                    if chosen[n][2]:
                        lines.append(chosen[n][2])
            if GRAMMAR.fullmatch("".join((r[:1] if r[:1] in "sua" and r else "?") for r, _ in lines)):
                yield cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def expected(rows):
    """Report of one conversation's rows (turn, role, text), None as the module says."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, faulted = set(), []
    for _, role, text in rows:
        bare = text.strip("\t\n\v\f\r ")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else \
            "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faulted.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulted, faulted[1:]))
    cost, audit, repaired = min(all_edits(faulted))
    return (gaps, *[sum(f == kind for _, _, f in faulted) for kind in ("blank", "duplicate", "truncated")], illegal,
            cost, audit, hashlib.sha256(repaired.encode()).hexdigest())


def result(spark, data, schema=SCHEMA):
    turns = spark.createDataFrame(data, schema)
    return {r.conv_id: tuple(r)[1:] for r in cr.repair_report(turns, cr.conversation_rows(turns)).collect()}


def test_equals_exhaustive_search(spark):
    rng = random.Random(13)
    data = []
    for conv in range(60):
        for turn in range(rng.randint(1, 4)):
            data.append((conv, rng.choice([turn, turn, turn + 1, None]),
                         rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "why ", " \t", "", None, "Ok. \n", "Yes."])))
    data += [(None, 0, "user", "A null id."), (None, 1, "assistant", "One conversation.")]
    data += [(100, 0, "user", "Same."), (100, 0, "user", "Same."), (100, 0, "user", "Same.")]
    got = result(spark, data)
    assert set(got) == {d[0] for d in data}
    for conv, row in got.items():
        assert row == expected([d[1:] for d in data if d[0] == conv]), conv


def test_damage_by_crc(spark):
    data = [(c, t, "assistant", "Wait... what? Yes.") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    rows = cr.conversation_rows(spark.createDataFrame(data, SCHEMA))
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in cr.damage(rows).collect()), key=repr)
    want = []
    for c, t, role, text in data:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        want += [(c, t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    assert got == sorted(want, key=repr)


def test_nodes_are_shared_between_signatures():
    rng = random.Random(3)
    signatures = sorted({"".join(rng.choices("suaDUA", k=rng.randint(0, 30))) + "uaua" for _ in range(300)},
                        key=lambda s: s[::-1])
    made = list(cr.solve(s[::-1] for s in signatures))
    # one node per distinct suffix, whatever conversation it came from
    assert sum(new for _, _, new in made) == len({s[i:] for s in signatures for i in range(len(s))})
    assert [m[:2] for m in made] == [next(cr.solve([s[::-1]]))[:2] for s in signatures]


def test_repaired_turns_follow_the_grammar(spark):
    roles = ["user", "user", "assistant", "system", "tool", "assistant"]
    data = [(c, t, roles[(c * 7 + t * 3) % 6], f"Line {t}." if (c + t) % 4 else "cut off")
            for c in range(30) for t in range(c % 9)]
    rows = cr.conversation_rows(spark.createDataFrame(data, SCHEMA))
    plans = cr.plan_repairs(rows)
    by_conv = {}
    for r in sorted(cr.repaired_turns(rows, plans).collect(), key=lambda r: (r.key, r.position)):
        by_conv.setdefault(r.key, []).append(r)
    digests = {r.key: r.repaired_sha256 for r in cr.repaired_digests(rows, plans).collect()}
    assert by_conv and set(digests) == set(by_conv)
    for key, turns in by_conv.items():
        assert [t.position for t in turns] == list(range(len(turns)))
        assert GRAMMAR.fullmatch("".join(t.role[0] for t in turns))
        assert digests[key] == hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest()


def test_long_conversation_and_hot_signature(spark):
    long_one = [(7, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(6000)]
    copies = [(1000 + c, t, ("user", "assistant")[t], "Hello there.") for c in range(500) for t in range(2)]
    got = result(spark, long_one + copies)
    assert got[7][:7] == (0, 0, 0, 0, 0, 0, "K" * 6000)
    assert {got[1000 + c][6] for c in range(500)} == {"KK"}


def test_empty_and_extra_columns(spark):
    assert result(spark, []) == {}
    data = [(1, 0, "user", "Hi.", "x", 3, "s"), (1, 1, "assistant", "Yes.", "y", 4, "t")]
    got = result(spark, data, SCHEMA + ", `key` string, kind int, signature string")
    assert got[1][5:7] == (0, "KK")
    turns = spark.createDataFrame([(5, 0, "user", "Gone.")], SCHEMA)
    none = cr.repair_report(turns, cr.conversation_rows(turns).where("false")).first()
    assert tuple(none) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
