import random

import pytest
from pyspark.sql import functions as F

from cladeflow.llm import mojibake

CLEAN = [
    "Überprüft die Größe der Schlüssel für große Bäume", "ajoute la clé générée à l’entrée déjà lue", "исправляет чтение пустых строк при медленном диске",
    "přidává načítání příloh když chybí klíč", "añade la función pequeña en producción", "修正缓存大小读取", "ενημερώνει την έκδοση του μετρητή",
    "plain ascii only", "temperature 5 °C – “quoted” text… →", "emoji ✨ and 🚀 here", "İşlem sırasını önbellek boyutunu günceller", "naïve café №5 ±3 × 2",
]


def garble(text, writer, reader):
    out = []
    for b in text.encode(writer):
        try:
            out.append(bytes([b]).decode(reader))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


CASES = [
    (0, lambda t: garble(t, "utf-8", "cp1252")), (1, lambda t: garble(t, "utf-8", "latin-1")), (2, lambda t: garble(t, "utf-8", "cp1252")),
    (2, lambda t: garble(t, "cp1251", "latin-1")), (3, lambda t: garble(t, "cp1250", "cp1252")), (4, lambda t: garble(t, "utf-8", "mac-roman")),
    (5, lambda t: garble(t, "utf-8", "cp1252")), (6, lambda t: garble(t, "utf-8", "latin-1")), (0, lambda t: garble(garble(t, "utf-8", "cp1252"), "utf-8", "cp1252")),
    (2, lambda t: garble(t, "koi8-r", "latin-1")), (1, lambda t: garble(t, "utf-8", "cp850")), (4, lambda t: t.encode("latin-1").decode("utf-8", "replace")),
]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        rows.append((i, "\n".join(rng.sample(CLEAN, 4)), None))
    for i, (no, make) in enumerate(CASES):
        rows.append((1000 + i, f"commit {i}\n\n    {make(CLEAN[no])}\n", f"commit {i}\n\n    {CLEAN[no]}\n"))
    rows += [(2000, None, None), (2001, "", None), (2002, "only �", None), (None, "Ã©", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string")
    return df.withColumn("word", F.lit("clash")).withColumn("df", F.lit(1)), rows


def test_found(corpus):
    got = {r.doc_id for r in mojibake.garbled_documents(corpus[0]).collect()}
    assert got == {1000 + i for i in range(len(CASES))}


def test_restored(corpus):
    truth = {r[0]: r[2] for r in corpus[1]}
    got = {r.doc_id: r for r in mojibake.restored_documents(corpus[0]).collect()}
    right = [d for d, r in got.items() if r.text == truth[d]]
    assert len(got) == len(CASES)
    assert len(right) >= len(CASES) - 3, {d: r.text for d, r in got.items() if d not in right}


def test_readings():
    assert mojibake.utf8_reading("fÃ¼r", "cp1252") == ("für", [("Ã¼", "ü")], True)
    assert mojibake.utf8_reading("огнём", "koi8-r") is None
    assert mojibake.utf8_reading("für", "latin-1") is None
    assert ("cp1251>cp1252", "счётчик") in set(mojibake.legacy_readings(garble("счётчик", "cp1251", "latin-1")))
    assert mojibake.words_of("plain") == set() and mojibake.words_of("a für(été)ß") == {"für", "été", "ß"}


def test_alignment():
    shown = {name: fits for name, fits, _ in mojibake.aligned(["Ã¼", "x"], ["ü", "x"])}
    assert shown["cp1252"] and shown["latin-1"]
    assert not any(fits for _, fits, _ in mojibake.aligned(["Ã¼"], ["ö"]))
    assert [t for t in mojibake.aligned(["а�"], ["аб"])] == [("lost", True, [])]
    assert list(mojibake.aligned(["a"], ["a"])) == [] and list(mojibake.aligned(["Ã¼"], ["ü", "é"])) == []
    one, other = mojibake.stripped_lines("+  // prÃ¼fen Sie\n"), mojibake.stripped_lines("   // prüfen Sie\r\nnur ü")
    assert {d for d, _ in one} == {d for d, _ in other} and {r for _, r in other} == {("ü",)}


def test_nothing_learned_without_twins(spark):
    rows = [(1, "plain"), (2, "Ã¼"), (3, "grün")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert mojibake.garbled_documents(df).count() == 0
    both = df.unionByName(spark.createDataFrame([(4, "so grÃ¼n wie Gras"), (5, "so grün wie Gras")], "doc_id long, text string"))
    assert {r.doc_id for r in mojibake.garbled_documents(both).collect()} == {2, 4}  # what the twins show holds for others


def test_garbled_five_times(spark):
    text = clean = "Überprüft die Größe der Schlüssel"
    for _ in range(6):
        text = garble(text, "utf-8", "latin-1")
    df = spark.createDataFrame([(1, text), (2, clean), (3, clean), (4, garble(clean, "utf-8", "latin-1"))], "doc_id long, text string")
    assert {r.doc_id: r.text for r in mojibake.restored_documents(df).collect()} == {1: clean, 4: clean}


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mojibake.garbled_documents(empty).count() == 0 and mojibake.restored_documents(empty).count() == 0


LONE = [
    ("删除错误提示，仅限夜间任务", "gbk", "cp1252"), ("エラーメッセージの削除、再起動後", "cp932", "cp1252"), ("木構造の巡回を高速化", "cp932", "latin-1"), ("空文字列の判定（夜間）", "euc-jp", "cp1252"),
    ("캐시", "cp949", "cp1252"), ("l’été’fûtôt", "cp1252", "mac-roman"),
]


def test_legacy_twins_alone(spark):
    """One word of a hypothesis, in more documents than its clean form."""
    rows = [(i, f"+ {w} x", None) for i, (w, _, _) in enumerate(LONE)]
    rows += [(10 * (i + 1) + k, f"+ ({garble(w, a, b)})", f"+ ({w})") for i, (w, a, b) in enumerate(LONE) for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string")
    assert {r.doc_id for r in mojibake.garbled_documents(df).collect()} == {r[0] for r in rows if r[2]}
    got = {r.doc_id: (r.text, r.n_words, r.n_restored) for r in mojibake.restored_documents(df).collect()}
    assert got == {r[0]: (r[2], 1, 1) for r in rows if r[2]}


def test_legacy_short(spark):
    """Short readings need longer words of the hypothesis in their documents."""
    rows = [(i, "добавляет настройку по умолчанию", None) for i in range(3)] + [(10, garble("настройку по умолчанию", "cp866", "cp1252"), None)]
    rows += [(20, "garden að", None), (21, "ağ", None), (22, "ağ", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string")
    assert {r.doc_id: r.text for r in mojibake.restored_documents(df).collect()} == {10: "настройку по умолчанию"}


def test_oddness():
    for clean, writer, reader in LONE:
        assert mojibake.oddness(garble(clean, writer, reader)) > mojibake.oddness(clean)
    assert mojibake.oddness("přidává") == mojibake.oddness("pøidává") == mojibake.oddness("«été»") == mojibake.oddness("修正API缓存，好") == 0
