"""op12: exhaustive search over whole conversations, row by row, is the measure."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from earworm.llm import turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, copies string, fault string, edits string"


@lru_cache(maxsize=None)
def brute_audit(rows: str) -> tuple[int, str]:
    """Cheapest, then ASCII-least, over every edit of every row; '-' must go."""
    best = {}

    def rest(i, phase, inserted):
        key = (i, phase, inserted)
        if key not in best:
            found = [(0, "")] if i == len(rows) and phase in (0, 3) else []
            if inserted < 3:
                c, a = rest(i, 3 if phase == 2 else 2, inserted + 1)
                found.append((c + 2, "I" + a))
            if i < len(rows):
                c, a = rest(i + 1, phase, 0)
                found.append((c + 3, "D" + a))
                row, extra = rows[i].lower(), 1 if rows[i].isupper() else 0
                if row != "-":
                    wanted = "a" if phase == 2 else "u"
                    after = 3 if phase == 2 else 2
                    c, a = rest(i + 1, after, 0)
                    found.append((c + extra + (0 if row == wanted else 2), ("K" if row == wanted else "R") + a))
                    if row == "s" and phase == 0:
                        c, a = rest(i + 1, 1, 0)
                        found.append((c + extra, "K" + a))
            best[key] = min(found, default=(10**9, ""))
        return best[key]

    for i in range(len(rows), -1, -1):  # from the end, so that recursion stays shallow
        for phase in range(4):
            for inserted in range(3, -1, -1):
                rest(i, phase, inserted)
    return rest(0, 0, 0)


def test_blocks_against_exhaustive_search():
    rng = random.Random(1)
    for n in [*range(0, 9)] * 60 + [15, 16, 17, 31, 32, 33, 50, 90] * 6:
        rows = "".join(rng.choice("uauauasxUASX") for _ in range(n))
        cost, audits, _ = turns.best_audit(rows, turns.START, turns.TAIL)
        assert (cost, "".join(audits)) == brute_audit(rows), rows


def test_shares_give_the_whole():
    """A conversation cut anywhere into shares is repaired as the whole one."""
    rng = random.Random(2)
    for _ in range(60):
        rows = "".join(rng.choice("uauasxUAX") for _ in range(rng.randint(2, 70)))
        cuts = sorted({0, len(rows), *(rng.randint(0, len(rows)) for _ in range(rng.randint(1, 4)))})
        shares = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
        plan = turns.chain_shares([turns.share_matrix(s) for s in shares])
        audit = []
        for k, (share, (entry, exit_)) in enumerate(zip(shares, plan)):
            end = turns.TAIL[exit_] if k == len(shares) - 1 else (0, "")
            audit += turns.best_audit(share, entry, {exit_: end})[1]
        assert "".join(audit) == brute_audit(rows)[1], (rows, cuts)


def test_band_and_limit():
    assert turns.align("ua", "ua", 0) == (0, "KK")
    assert turns.align("uu", "uaua", 4) is None  # would end with an insertion
    assert turns.align("uu", "uau", 2) == (2, "KIK")
    assert turns.align("uu", "ua", 1) is None
    assert turns.align("", "", 0) == (0, "")
    assert turns.align("X", "u", 3) == (3, "R")


def damage(data):
    out = []
    for conv, turn, role, text in data:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if role is None else role), (" " if text is None else text)
        code = zlib.crc32(name.encode()) % 20
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def brute(data):
    found = {}
    for conv in {d[0] for d in data}:
        mine = [d for d in damage(data) if d[0] == conv]
        mine.sort(key=lambda d: (d[1] is not None, d[1] or 0, d[2],
                                 hashlib.sha256(f"{len(d[2])}:{d[2]}{d[3]}".encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            if not marks:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if marks[-1] in ".!?" else "truncated")
            seen.add((role, text))
        letters = ""
        for d, fault in zip(mine, faults):
            c = d[2][:1] if d[2][:1] in ("s", "u", "a") else "x"
            letters += "-" if fault in ("blank", "duplicate") else c.upper() if fault else c
        cost, audit = brute_audit(letters)
        out, i, last = [], 0, ""
        for edit in audit:
            if edit == "K":
                out.append(f"{mine[i][2]}:{mine[i][3]}")
                last = mine[i][2][:1]
            elif edit in "RI":
                last = "a" if last == "u" else "u"
                out.append({"u": "user", "a": "assistant"}[last] + ":" + (mine[i][3] if edit == "R" else ""))
            i += edit != "I"
        initials = [d[2][:1] for d in mine]
        numbers = [d[1] for d in mine if d[1] is not None]
        found[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                       faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                       sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                       cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return found


def some_rows(seed=3):
    rng = random.Random(seed)
    texts = ["Hello.", "Yes!", "no end", "why?", "", " \n", None, "A longer answer. And more", "Hello.", "ok\x0b."]
    data = []
    for conv in range(150):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            data.append((conv, rng.choice([turn, turn, turn, None, turn - 3]), role, rng.choice(texts) if rng.random() < .4
                         else f"Turn {turn} of {conv}."))
    for turn in range(700):  # one long conversation, with one message at every tenth turn
        data.append((1000, turn, ["user", "assistant"][turn % 2], "The same." if turn % 10 == 0 else f"Number {turn}."))
    data += [(2000, 5, "user", "Repeated row.")] * 40 + [(None, None, "user", "No ids."), (None, 1, "assistant", "No id.")]
    data += [(3000 + c, t, "user", "x.") for c in range(60) for t in range(1)]
    return [(*d, "d", "c", "f", "e") for d in data]


def as_rows(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_conversations_against_exhaustive_search(spark, parts):
    """Long conversations lie in several of the 40 parts, in one of 1."""
    data = some_rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = turns.digests(turns.repaired(turns.damaged(df), parts))
    want = brute([d[:4] for d in data])
    assert got.count() == len(want)
    assert as_rows(got) == want
    assert as_rows(turns.repair_digests(turns.damaged(df), parts)) == want
    assert any(v[6] == "" and v[7] == hashlib.sha256(b"").hexdigest() for v in want.values())  # no row left


def test_repaired_rows(spark):
    data = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Still there?"), (1, 3, "assistant", "Hi.")]
    rows = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 copies")
    got = [tuple(r) for r in turns.repaired(rows).collect()]
    assert got == [(1, "K", 0, "system", "", "system", "Be kind."), (1, "K", 1, "user", "", "user", "Hi."),
                   (1, "I", None, None, "", "assistant", ""), (1, "K", 2, "user", "", "user", "Still there?"),
                   (1, "K", 3, "assistant", "", "assistant", "Hi.")]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert turns.digests(turns.repaired(turns.damaged(df))).count() == 0
