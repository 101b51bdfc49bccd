"""Repairs equal those of an exhaustive search; reports equal a plain Python version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from ticketlens.llm import turns

LEGAL = re.compile(r"(s?(ua)+)?\Z")
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}


def exhaustive(initials, faults):
    """The least (cost, letters) over all edits, with up to two turns inserted in each place."""
    choices = [["D"] if f in (turns.BLANK, turns.DUPLICATE) else ["D", "K", "Ru", "Ra"] for f in faults]
    gaps = ["", "u", "a", "ua", "au"]
    best = None
    for picks in itertools.product(*choices):
        for inserted in itertools.product(gaps, repeat=len(initials) + 1):
            letters, made, cost = "I" * len(inserted[0]), inserted[0], 0
            for initial, fault, pick, more in zip(initials, faults, picks, inserted[1:]):
                letters += pick[0] + "I" * len(more)
                made += {"D": "", "K": initial or "?", "Ru": "u", "Ra": "a"}[pick] + more
                cost += 3 * (fault == turns.TRUNCATED and pick != "D")
            if LEGAL.match(made):
                cost += sum(COSTS[c] for c in letters)
                best = min(filter(None, (best, (cost, letters))))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_repair(seed):
    draw = random.Random(seed)
    for n in (0, 1, 2, 3):
        for _ in range(6):
            initials = [draw.choice("suaax") if draw.random() < 0.95 else "" for _ in range(n)]
            faults = [draw.choice([turns.FINE, turns.FINE, turns.TRUNCATED, turns.BLANK, turns.DUPLICATE]) for _ in range(n)]
            assert turns.cheapest(initials, faults) == exhaustive(initials, faults), (initials, faults)


@pytest.mark.parametrize("span", [1, 2, 3, 7])
def test_spans_change_nothing(span):
    draw = random.Random(span)
    for n in (1, 5, 20, 61):
        initials = [draw.choice("suaaux") for _ in range(n)]
        faults = [draw.choice([0, 0, 0, turns.TRUNCATED, turns.BLANK]) for _ in range(n)]
        assert turns.cheapest(initials, faults, span) == turns.cheapest(initials, faults, 10**6)


def test_very_long_conversations_stay_linear():
    cost, letters = turns.cheapest(["u", "a"] * 10_000 + ["u"], bytes(20_001))
    assert cost == 3 and letters == "K" * 20_001 + "I"


def known(value):
    return " " if value is None else str(value)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        part = zlib.crc32(f"{known(conv)}:{known(turn)}".encode()) % 20
        role, text = known(role), known(text)
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        role = "user" if part == 4 else role
        out += [(conv, turn, role, text)] * (0 if part == 0 else 2 if part == 3 else 1)
    return out


def plain_report(rows, ids):
    out = []
    for conv in set(ids):
        own = sorted(
            (r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
        )
        faults, seen = [], set()
        for _, role, text in own:
            body = text.strip("\x20\t\n\x0b\x0c\r")
            faults.append(
                turns.BLANK if not body else turns.DUPLICATE if (role, text) in seen else turns.TRUNCATED if body[-1] not in ".!?" else turns.FINE
            )
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = turns.cheapest(initials, faults, 10**6)
        made, rest = [], list(own)
        for letter in audit:
            row = rest.pop(0) if letter != "I" else (None, "", "")
            if letter != "D":
                led = bool(made) and made[0][0][:1] == "s"
                forced = "user" if (len(made) - led) % 2 == 0 else "assistant"
                made.append((row[1] if letter == "K" else forced, row[2]))
        text = "\n".join(f"{r}:{t}" for r, t in made)
        counts = [faults.count(f) for f in (turns.BLANK, turns.DUPLICATE, turns.TRUNCATED)]
        out.append((str(conv), gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


COLUMNS = ("conv_id", *turns.FIGURES, "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, fault string, kind string, digest string, figures string, copy string"


def conversations():
    draw = random.Random(8)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]
    texts = ["Hello.", "Yes!", "and then", " \t\n", "", None, "Same words?", "Same words?", "Wirklich ... 東京。", "end.  \n"]
    rows = [(c, t, draw.choice(roles[:5] if c < 30 else roles), draw.choice(texts)) for c in range(45) for t in range(draw.randint(1, 6))]
    rows += [(100, None, "user", "No turn."), (100, None, "user", "No turn."), (100, 4, "assistant", "x"), (None, 1, "user", "Hi."), (None, None, None, None)]
    rows += [(101, 7, "user", "Tie."), (101, 7, "assistant", "Tie."), (101, 7, "user", "Another."), (101, 2**60, "user", "Far."), (102, 0, "user", "long " * 50_000)]
    rows += [(200, t, ("user", "assistant")[t % 2], f"Turn {t % 90}.") for t in range(700)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA).repartition(4)


def test_report_of_damaged_rows(spark):
    rows = conversations()
    df = table(spark, rows)
    found = sorted((str(r["conv_id"]), *[r[c] for c in COLUMNS[1:]]) for r in turns.report(turns.damaged(df), ids=df).collect())
    assert found == plain_report(plain_damage(rows), [r[0] for r in rows])


def test_repaired_turns_hash_to_the_report(spark):
    df = table(spark, [r for r in conversations() if r[0] is not None and r[0] < 150])
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in turns.report(df).collect()}
    texts = {}
    for r in turns.repaired(df).orderBy("conv_id", "place").collect():
        assert r["place"] == len(texts.setdefault(r["conv_id"], [])) + 1
        texts[r["conv_id"]].append((r["role"], r["text"]))
    for conv, digest in hashes.items():
        made = texts.get(conv, [])
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest() == digest
        assert LEGAL.match("".join(r[0] for r, _ in made))


def test_empty_table(spark):
    df = table(spark, [(1, 1, "user", "x")]).limit(0)
    assert turns.report(turns.damaged(df), ids=df).collect() == [] and turns.repaired(df).collect() == []
