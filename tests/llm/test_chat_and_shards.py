import random
from collections import Counter

import brute
import pytest

from salesmart.llm import chat_snapshots as H
from salesmart.llm import shard_table as T

SCHEMA = "conv_id long, turn long, role string, text string, n long, h1 long, part long, block int"


def _logs(seed):
    rng = random.Random(seed)
    out, logs = [], []
    for conv in range(60):
        if logs and rng.random() < 0.6:
            said = list(rng.choice(logs))[:rng.randint(1, 6)]
            said += [(rng.choice(["user", "assistant", None]), rng.choice(["x", "y", "", None])) for _ in range(rng.randint(0, 2))]
        else:
            said = [(rng.choice(["user", "assistant"]), rng.choice(["a", "b", "ab"])) for _ in range(rng.randint(1, 7))]
        logs.append(said)
        first = rng.choice([0, 1, 10])
        out += [(conv, first + 2 * i, r, t, 1, 2, 3, 4) for i, (r, t) in enumerate(said)]
    out += rng.choices(out, k=10)  # repeated rows
    out += [(None, 1, "user", "lost", 1, 2, 3, 4), (3, None, "user", "lost", 1, 2, 3, 4)]
    rng.shuffle(out)
    return out


def _maximal(rows):
    said: dict = {}
    for c, turn, role, text, *_ in set(rows):
        if c is not None and turn is not None:
            said.setdefault(c, set()).add((turn, role or "", text or ""))
    logs = {c: [s[1:] for s in sorted(v, key=lambda s: s[0])] for c, v in said.items()}
    kept = {}
    for c, own in logs.items():
        longer = any(len(o) > len(own) and o[:len(own)] == own for o in logs.values())
        earlier = any(o == own and k < c for k, o in logs.items())
        if not longer and not earlier:
            kept[c] = own
    return kept


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block", [2, 4096])
def test_maximal_conversations_stay(spark, seed, block, monkeypatch):
    monkeypatch.setattr(H, "_BLOCK", block)
    rows = _logs(seed)
    got = H.collapsed_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id: r.text for r in got} == {
        c: "".join(f"<|{role}|>\n{text}\n" for role, text in own) for c, own in _maximal(rows).items()}
    assert all(r.n_turns == len(_maximal(rows)[r.conv_id]) for r in got)


def test_a_long_conversation_takes_several_rows(spark):
    rows = [(1, i, "user", f"t{i}", 0, 0, 0, 0) for i in range(1300)] + [(2, i, "user", f"t{i}", 0, 0, 0, 0) for i in range(700)]
    got = sorted(H.collapsed_chats(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.part)
    assert [r.conv_id for r in got] == [1, 1, 1]
    assert "".join(r.text for r in got) == "".join(f"<|user|>\nt{i}\n" for i in range(1300))


def test_no_conversations_and_no_python(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.collapsed_chats(none).count() == 0
    plan = H.prefixes(none)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_the_table_is_even_and_changes_little():
    names = [f"s{i}" for i in range(13)]
    own = T.fill_table(names, 2053)
    share = Counter(own)
    assert max(share.values()) - min(share.values()) <= 1 and len(own) == 2053
    fewer = T.fill_table(names[:-1], 2053)
    moved = sum(a != b for a, b in zip(own, fewer) if a != 12)
    assert moved / 2053 < 0.25
    assert T.fill_table(["only"], 3) == [0, 0, 0]


def test_filling_follows_turns():
    """The plain form: each shard walks its whole preference list at its turn."""
    names, slots = ["a", "b", "c"], 31
    prefer = []
    for n in names:
        first, skip = T._number(f"offset:{n}") % slots, T._number(f"skip:{n}") % (slots - 1) + 1
        prefer.append([(first + k * skip) % slots for k in range(slots)])
        assert sorted(prefer[-1]) == list(range(slots))
    owner: dict = {}
    while len(owner) < slots:
        for s in range(3):
            if len(owner) < slots:
                owner[next(p for p in prefer[s] if p not in owner)] = s
    assert T.fill_table(names, slots) == [owner[i] for i in range(slots)]


@pytest.mark.parametrize("names,slots", [([], 31), (["a", "a"], 31), (["a"], 30), (["a", "b", "c", "d"], 3)])
def test_bad_tables_are_refused(names, slots):
    with pytest.raises(ValueError):
        T.fill_table(names, slots)


def test_placement(spark, tmp_path):
    import hashlib
    docs, rows = brute.odd_documents(spark)
    names = [f"s{i}" for i in range(7)]
    own = T.fill_table(names, 101)
    docs = docs.withColumnRenamed("h", "Slot")
    got = T.place(docs, "doc_id", names, 101)
    assert got.count() == len(rows)
    for r in got.collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard, r.shard_name) == (slot, own[slot], names[own[slot]])
    T.write_shards(got.drop("_id", "_key"), str(tmp_path / "out"), files=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and back.where("shard_name <> concat('s', shard)").count() == 0
    assert T.place(brute.empty_documents(spark), "doc_id", names, 101).count() == 0
