"""Pseudonyms: permutations, checks that still hold, and linked values."""

import datetime as dt
import hashlib
import random
import re

from pyspark.sql import functions as F

from siftload.llm import pseudonyms

KEY = "k"


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def test_feistel_is_a_permutation_with_an_inverse(spark):
    for left, right in ((10, 10), (92, 397), (7, 3), (1, 1)):
        n = left * right
        rows = spark.range(n).select("id", pseudonyms.feistel(F.col("id"), KEY, "t", left, right).alias("p"))
        rows = rows.withColumn("back", pseudonyms.feistel_back(F.col("p"), KEY, "t", left, right)).collect()
        assert sorted(r["p"] for r in rows) == list(range(n))
        assert all(r["back"] == r["id"] for r in rows)


def test_days_of_a_century_are_permuted(spark):
    for first, days in ((dt.date(1900, 1, 1), 36524), (dt.date(2000, 1, 1), 36525)):
        moved = spark.range(days).select(pseudonyms.moved_date(F.date_add(F.lit(first), F.col("id").cast("int")), KEY).alias("d"))
        assert moved.distinct().count() == days
        assert {r[0] for r in moved.selectExpr("min(d)").collect()} == {first}


def plain_feistel(value, key, tweak, left, right):
    a, b = divmod(value, right)
    drawn = lambda r, c: int(hashlib.sha256(f"{key}|{tweak}|{r}|{c}".encode()).hexdigest()[:13], 16)
    for r in range(pseudonyms.ROUNDS):
        if r % 2 == 0:
            a = (a + drawn(r, b)) % left
        else:
            b = (b + drawn(r, a)) % right
    return a * right + b


def plain_digits(number, tweak):
    n = len(number)
    return str(plain_feistel(int(number), KEY, tweak, 10 ** (n - n // 2), 10 ** (n // 2))).zfill(n)


def check_digit(payload):
    return next(d for d in "0123456789" if luhn(payload + d))


def plain_card(number):
    if luhn(number):
        moved = plain_digits(number[:-1], "card")
        return moved + check_digit(moved)
    off = (int(number[15]) - int(check_digit(number[:15])) - 1) % 10
    front, off = divmod(plain_feistel(int(number[:15]) * 9 + off, KEY, "failing", 9 * 10**7, 10**8), 9)
    front = str(front).zfill(15)
    return front + str((int(check_digit(front)) + 1 + off) % 10)


def plain_ssn(number):
    area, group, serial = map(int, number.split("-"))
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    block, serial = divmod(plain_feistel(rank, KEY, "ssn", 898 * 99, 9999), 9999)
    area, group = divmod(block, 99)
    return f"{area + 1 + (area + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def plain_iban(account):
    moved = plain_digits(account, "iban")
    return f"DE{98 - int(moved + '131400') % 97:02d}{moved}"


def test_large_numbers_stay_a_permutation(spark):
    """Where a division as doubles rounds up: lower halves of nines, both ends and every carry."""
    half = 10**9
    values = sorted({v for b in (0, 1, 10, 999, half // 2, half - 2, half - 1) for a in (b - 1, b, b + 1) if 0 <= a < half for v in (a * half, a * half + 1, a * half + half - 2, a * half + half - 1)})
    for left, right in ((half, half), (10**9, 10**8), (9 * 10**7, 10**8)):
        inside = [v for v in values if v < left * right]
        rows = spark.createDataFrame([(v,) for v in inside], "id long").select("id", pseudonyms.feistel(F.col("id"), KEY, "t", left, right).alias("p"))
        rows = rows.withColumn("back", pseudonyms.feistel_back(F.col("p"), KEY, "t", left, right)).collect()
        assert all(r["back"] == r["id"] and r["p"] == plain_feistel(r["id"], KEY, "t", left, right) for r in rows)
        assert len({r["p"] for r in rows}) == len(inside)


def test_numbers_against_a_plain_version(spark):
    rng = random.Random(5)
    cards = [p + check_digit(p) for p in (str(rng.randrange(10 ** (n - 2), 10 ** (n - 1))) for n in (13, 14, 15, 16, 17, 18, 19) for _ in range(12))] + ["9999999999999999", "0000000000000000", "9" * 18 + check_digit("9" * 18)]
    cards += [str(rng.randrange(10**15, 10**16)) for _ in range(40)]
    ssns = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 99) for s in (1, 9999)] + [f"{rng.randrange(1, 600):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}" for _ in range(200)]
    accounts = ["999999999999999999", "000000000999999999", "000000000000000000", *(str(rng.randrange(10**17, 10**18)) for _ in range(40))]
    ibans = [f"DE{98 - int(a + '131400') % 97:02d}{a}" for a in accounts]
    new = [r["text"] for r in change(spark, cards + ssns + ibans)]
    assert new[: len(cards)] == [plain_card(c) for c in cards]
    assert new[len(cards) : len(cards) + len(ssns)] == [plain_ssn(s) for s in ssns]
    assert new[len(cards) + len(ssns) :] == [plain_iban(a) for a in accounts]
    assert [luhn(a) for a in cards] == [luhn(b) for b in new[: len(cards)]] and len(set(new)) == len(set(cards + ssns + ibans))
    for s in new[len(cards) : len(cards) + len(ssns)]:
        area, group, serial = map(int, s.split("-"))
        assert 0 < area < 900 and area != 666 and group and serial


def change(spark, texts):
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_card int")
    return [r.asDict() for r in pseudonyms.pseudonymise(df, KEY).orderBy("doc_id").collect()]


def test_formats(spark):
    card, iban = "4111 1111-1111 1111", "DE89 3704 0044 0532 0130 00"
    texts = [
        f"a {card} b 4111111111111111 c", f"x{iban}. {iban}", "IP 10.0.0.1, 10.0.0.1 and 999.1.1.1", "+1 (017) 555-7713 +1 0175557713",
        "on 2024-02-29 and 2023-02-29, 31.12.1999", "ssn 123-45-6789 000-12-3456", "m.n.97@mail6.example.com### M.n.97@mail6.example.com",
        'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', "1234567890123456", "12345678901234567", "", None, "no data at all",
    ]
    out = change(spark, texts)
    new = [r["text"] for r in out]
    cards = re.findall(r"[0-9][0-9 -]{11,}[0-9]", new[0])
    plain = [re.sub("[^0-9]", "", c) for c in cards]
    assert plain[0] == plain[1] != "4111111111111111" and luhn(plain[0]) and re.fullmatch(r"\d{4} \d{4}-\d{4} \d{4}", cards[0]) and out[0]["n_card"] == 2
    assert new[1] == texts[1].replace(iban, re.search("DE[0-9 ]+[0-9]", new[1])[0]) or iban in new[1][:30]
    moved = re.findall(r"DE[0-9 ]+[0-9]", new[1])[-1].replace(" ", "")
    assert int(moved[4:] + "1314" + moved[2:4]) % 97 == 1 and moved != iban.replace(" ", "")
    ips = re.findall(r"[0-9.]+[0-9]", new[2])
    assert ips[0] == ips[1] != "10.0.0.1" and all(int(o) < 256 for o in ips[0].split(".")) and ips[2] == "999.1.1.1"
    phones = [re.sub("[^0-9]", "", p) for p in re.findall(r"\+1[0-9 ()-]+[0-9]", new[3])]
    assert phones[0] == phones[1] != "10175557713" and new[3].startswith("+1 (")
    dates = re.findall(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", new[4])
    assert dates[0] != "2024-02-29" and dt.date.fromisoformat(dates[0]).year >= 2000 and dates[1] == "2023-02-29" and "31.12.1999" not in new[4]
    assert "123-45-6789" not in new[5] and "000-12-3456" in new[5]
    assert "mail6" not in new[6] and len(set(re.findall(r"u[0-9a-f]{16}@example\.invalid", new[6]))) == 1 and "###" in new[6]
    assert "2abc3ff2" not in new[7] and re.fullmatch('token = "[0-9a-f]{40}"', new[7])
    assert new[8] != texts[8] and re.fullmatch("[0-9]{16}", new[8]) and new[9] == texts[9]
    assert new[10:] == texts[10:] and out[11]["n_card"] == 0


def test_cards_beside_other_numbers(spark):
    ip, date, card16, mistyped = "97.51.17.173", "2021-03-04", "4111 1111 1111 1111", "9807915762804490"
    texts = [
        f"ip {ip} {mistyped}", f"order 12 {card16}", f"on {date} {card16}", f"{card16} {date}", f"31.12.1999 {card16} 123", f"in 2021 {card16}",
        f"{card16} 4111-1111-1111-1111 {card16}", "7 3782 822463 10005 9", "12 6011 1111 1111 1117 000", "id 5 4111 1111 1111 1112", f"12345678901234567 {card16}", "12 34567 89012 34567",
    ]
    values = [ip, date, card16, "31.12.1999", mistyped]
    moved = dict(zip(values, [r["text"] for r in change(spark, values)], strict=True))
    out = change(spark, texts)
    new = [r["text"] for r in out]
    assert moved[mistyped] != mistyped and new[0] == f"ip {moved[ip]} {moved[mistyped]}"
    assert new[1] == f"order 12 {moved[card16]}" and new[5] == f"in 2021 {moved[card16]}"
    assert new[2] == f"on {moved[date]} {moved[card16]}" and new[3] == f"{moved[card16]} {moved[date]}"
    assert new[4] == f"{moved['31.12.1999']} {moved[card16]} 123"
    assert new[6] == f"{moved[card16]} {moved[card16].replace(' ', '-')} {moved[card16]}" and out[6]["n_card"] == 3
    amex = re.fullmatch(r"7 ([0-9]{4} [0-9]{6} [0-9]{5}) 9", new[7])[1]
    assert amex != "3782 822463 10005" and luhn(amex.replace(" ", ""))
    assert new[8].startswith("12 ") and "6011 1111 1111 1117" not in new[8] and out[8]["n_card"] == 1
    assert re.fullmatch(r"id 5 [0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}", new[9]) and new[9] != texts[9]
    assert new[10] == f"12345678901234567 {moved[card16]}" and out[10]["n_card"] == 1
    assert (new[11] == texts[11]) == (out[11]["n_card"] == 0)
    assert [r["n_card"] for r in out[:6]] == [1] * 6


def test_empty_and_repeated_rows(spark):
    assert change(spark, []) == []
    a, b = change(spark, ["call +1 (017) 555-7713"] * 2)
    assert a["text"] == b["text"]


def test_given_documents_keep_everything_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = pseudonyms.pseudonymise(docs, KEY)
    assert out.columns[: len(docs.columns)] == docs.columns
    shape = F.regexp_replace(F.regexp_replace("text", pseudonyms.EMAIL, "@"), "[0-9a-f]+", "#")
    shape_of = lambda df: sorted((r[0], r[1]) for r in df.select("doc_id", shape).collect())
    same = [a == b for a, b in zip(shape_of(docs), shape_of(out), strict=True)]
    assert sum(same) / len(same) > 0.9
