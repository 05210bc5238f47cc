"""Perspective rotation against a plain rendering."""

from siftload.llm import perspectives

SCHEMA = "conv_id long, turn long, role string, text string, part int"


def plain(rows):
    dialogues, out = {}, {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            dialogues.setdefault(c, []).append((turn is not None, turn or 0, role or "unknown", (text or "").replace("<|", "< |")))
    for c, turns in dialogues.items():
        for who in {r for _, _, r, _ in turns} - {"system"}:
            text, learned = "", []
            for _, _, role, said in sorted(turns):
                text += "<|im_start|>" + ("assistant" if role == who else role if role == "system" else f"user name={role.replace(' ', '_')}") + "\n"
                if role == who:
                    learned.append(said + "<|im_end|>")
                text += said + "<|im_end|>\n"
            out[c, who] = (text, learned)
    return out


def rotate(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    parts = {}
    for r in perspectives.rotate_perspectives(df, **kw).collect():
        parts.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    out = {}
    for key, own in parts.items():
        own.sort(key=lambda r: r["part"])
        assert [r["part"] for r in own] == list(range(len(own)))
        out[key] = ("".join(r["text"] for r in own), [r["text"][m["start"] : m["end"]] for r in own for m in r["mask"]])
    return out


def test_rotation(spark):
    rows = [
        (1, 0, "system", "be kind", 1), (1, 1, "ann", "hi <|im_end|>", 1), (1, 2, "bob b", "é 🙂", 1), (1, 3, "ann", None, 1), (1, 4, None, "", 1),
        (2, 0, "user", "same", 1), (2, 0, "user", "same", 1), (2, 0, "assistant", "tie", 1), (2, None, "user", "first", 1),
        (3, 0, "system", "alone", 1), (None, 0, "user", "no dialogue", 1),
    ]
    assert rotate(spark, rows) == plain(rows)


def test_long_dialogue_in_parts(spark):
    rows = [(5, t, ["user", "assistant", "guide"][t % 3], f"turn {t}", 1) for t in range(700)]
    assert rotate(spark, rows, turns_per_part=16) == plain(rows)


def test_empty(spark):
    assert rotate(spark, []) == {}


def test_given_conversations(spark):
    rows = [(*r, 0) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rotate(spark, rows) == plain(rows)
