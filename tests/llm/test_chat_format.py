import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tabula.llm import chat_format as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PIECES = ["[INST]", "[/INST]", "[SYS]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[+]", "[\\INST]", "[\\\\INST]",
          "\\", "<", "[", "]", ">", "/s>", "INST]", "+]", "\n", " ", "é", "😀", "a", "$1", "\\$"]


def rows():
    rng = random.Random(7)
    out = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (2, 0, "user", None), (2, 1, "assistant", ""),
           (3, 0, "user", "a"), (3, 1, "user", "b"), (3, 2, "assistant", "c"), (3, 3, "assistant", ""),
           (3, 4, "assistant", "d"), (4, None, None, None), (4, 0, "tool", "x"), (4, 0, "tool", "x"),
           (4, 0, "a[/ROLE]\n", "y"), (None, 0, "user", "alone"), (None, 0, "user", "alone"),
           (None, 1, "assistant", None), (5, 1, "assistant", "tie b"), (5, 1, "assistant", "tie a"),
           (6, 0, "system", "s"), (6, 1, "system", ""), (6, 2, "", "empty role"),
           (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
           (7, 0, "user", "long " * 60_000), (8, 0, "user", ""), (9, 0, "assistant", "")]
    for conv in range(10, 60):
        for turn in range(rng.randint(1, 12)):
            out.append((conv, turn, rng.choice(["user", "assistant", "system", "tool"]),
                        "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))))
    out += [(99, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(3000)]
    return out


def plain(conv):
    """(turns, learned text, formatted text) of one conversation's rows, without Spark."""
    turns = sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in conv))
    mark = re.compile(r"([<\[]\\*)((?<=[\\<\[])(?:s>|/s>|INST\]|/INST\]|SYS\]|ROLE\]|/ROLE\]|\+\]))")

    def escape(text):
        return mark.sub(lambda m: m[0] if (m[1][0] == "<") != (m[2] in ("s>", "/s>"))
                        else m[1] + "\\" + m[2], text)

    out = "<s>"
    for role, block in itertools.groupby(turns, key=lambda t: t[2]):
        out += {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]"}.get(role, f"[ROLE]{escape(role)}[/ROLE]")
        out += "[+]".join(escape(t[3]) for t in block) + ("</s>" if role == "assistant" else "")
    return ([t[2:] for t in turns], "".join(t[3] for t in turns if t[2] == "assistant"), out)


@pytest.fixture(scope="module")
def done(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4, "text")
    clashing = {c: F.lit("clash") for c in ("turns", "own", "blocks", "segments", "formatted", "texts", "loss")}
    return C.formatted(df.withColumns(clashing)).cache()


def conversations():
    known = {}
    for row in rows():
        known.setdefault(row[0] if row[0] is not None else object(), []).append(row)
    return list(known.values())


def test_equals_plain_formatting(done):
    want = sorted(plain(c)[2] for c in conversations())
    got = done.collect()
    assert sorted(r.formatted for r in got) == want
    assert all("".join(s.text for s in r.segments) == r.formatted for r in got)


def test_digests_are_of_the_input(done):
    want = []
    for conv in conversations():
        turns, learned, text = plain(conv)
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        want.append((conv[0][0], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest(), len(text)))
    assert sorted(map(tuple, C.digests(done).collect()), key=repr) == sorted(want, key=repr)


def test_no_marker_inside_a_segment_of_text(done):
    for row in done.collect():
        texts = [s.text for s in row.segments[2::1] if s.text not in C.INST.markers()]
        body = [t for t in texts if not t.startswith("[ROLE]")]
        assert not any(m in t for t in body for m in C.INST.markers())


@pytest.mark.parametrize("seed", range(5))
def test_escaping_is_reversible(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 15))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", C.escaped(F.col("t")).alias("e")).select("t", "e", C.unescaped(F.col("e")).alias("u"))
    for r in df.collect():
        assert r.u == r.t and not any(m in r.e for m in C.INST.markers())


def test_another_template(spark):
    chat = C.Template(begin="<|begin|>", opening={"user": "<|user|>", "assistant": "<|bot|>"},
                      closing={"user": "<|end|>", "assistant": "<|eot|>"}, named="<|role|>",
                      end_name="<|name|>", also="<|and|>", learned="user")
    df = spark.createDataFrame([(1, 0, "user", "<|bot|>"), (1, 1, "user", "b"), (1, 2, "judge", "[INST]")], SCHEMA)
    row = C.formatted(df, chat).first()
    assert row.formatted == "<|begin|><|user|><\\|bot|><|and|>b<|end|><|role|>judge<|name|>[INST]"
    turns = C.formatted(df, chat).select(C.read_back(F.col("formatted"), chat).alias("t")).first().t
    assert [tuple(t) for t in turns] == [("user", "<|bot|>"), ("user", "b"), ("judge", "[INST]")]


def test_markers_that_could_arise_by_chance_are_refused():
    with pytest.raises(ValueError):
        C.Template(also="[[")
    with pytest.raises(ValueError):
        C.Template(begin="<\\s>")


def test_empty_table(spark):
    assert C.digests(C.formatted(spark.createDataFrame([], SCHEMA))).collect() == []


def test_only_spark_expressions(done):
    plan = C.digests(done)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
