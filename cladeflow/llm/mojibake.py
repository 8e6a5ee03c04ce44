"""Garbled text: stretches that were decoded with another encoding than they were written in.

Unit is the word with characters outside ASCII, as garbling may hit a line, a name or part of a line.

1. Twins. Lines and words are joined on their text stripped of non-ASCII characters (a mark stands where a run of them was):
   every variant of a stripped text with the variant that most documents hold. Clean copies of a
   garbled line or word are found this way whatever happened to it.
2. Alignment. The runs of two twins are aligned character by character: a clean character stands against as many garbled ones
   as it has bytes, or the runs against each other where the reader's own characters are wide. A pair of encodings that
   accounts for all aligned runs is the name of the transformation; it is learned if it accounts for a sufficient share of the
   twins that it could be applied to, and with it the aligned sequences. Words without ASCII letters have nothing left when stripped; they
   are twins of the words that they read as. Nothing is learned of encodings without twins.
3. The learned transformations are applied to all remaining words, again and again until a reading changes nothing. A reading
   holds if its result is a word of the corpus, or if each of its characters was aligned so with a twin or is at least as often
   seen outside such readings as in them.
4. Older encodings read as one another keep the length of words, so any two words may look like twins. Their
   transformations are learned from whole words: those whose reading under a hypothesis is a word of the corpus, more often than chance has it.

Characters of two bytes may hold ASCII punctuation when read as single ones. Such stretches are units beside the words.

Every variant meets one representative of its stripped text, and readings meet words by equality: no pairs within a
group are built.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.session import spread, written

# Encodings, the names that learned transformations can have.
UTF8_READERS = [
    "cp1252", "latin-1", "mac-roman", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "cp1258", "iso8859-2", "iso8859-5",
    "iso8859-7", "iso8859-9", "iso8859-15", "koi8-r", "koi8-u", "cp437", "cp850", "cp852", "cp866", "gbk", "big5", "cp932", "cp949",
]
WIDE = {"gbk", "big5", "cp932", "cp949"}
PAIRED_WRITERS = ["cp932", "gbk", "big5", "cp949", "euc-jp"]
LEGACY_WRITERS = [
    "cp1252", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "iso8859-5", "cp1253", "iso8859-7", "cp1254", "cp1255", "cp1256",
    "cp1257", "mac-roman", "mac-cyrillic", "cp437", "cp850", "cp852", "cp932", "gbk", "big5", "cp949", "euc-jp",
]
LEGACY_READERS = ["cp1252", "mac-roman", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp437", "cp850", "cp866", "gbk"]

#: Share of the twins that a transformation applies to which it must account for.
LEARNED_SHARE = 0.25
#: ASCII letters that a stripped line or word must hold to tell twins from other texts.
LINE_LETTERS, WORD_LETTERS = 4, 2
#: Standard deviations by which words that confirm a legacy hypothesis must exceed the number that chance has.
DEVIATIONS = 3
#: Letters of a legacy word that its twin must have, where its hypothesis and the frequencies decide.
LEGACY_LETTERS = 3
#: Characters outside ASCII (of the word or its reading) from which a twin counts by itself: chance meets no such word.
LONG = 4

_WORD = re.compile(r"[^\x00-\x7f]+(?:[A-Za-z]*[^\x00-\x7f]+)*[A-Za-z]*")
_RUN = re.compile(r"[^\x00-\x7f]+")
_SEQUENCE = re.compile(
    rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}"
)
_LOST = "�"
_MARK = "\x01"
_STRETCH = re.compile(r"[^\x00-\x7f][^\x00-\x3f\x7f]*")
_TRAIL = r"[@\[-`{-~]"
_HAS_TRAIL = re.compile(_TRAIL)


def words_of(text: str) -> set[str]:
    """The distinct words with characters outside ASCII, ASCII letters next to them included."""
    found = set()
    if text.isascii():
        return found
    for m in _WORD.finditer(text):
        start = m.start()
        while start and (text[start - 1].isascii() and text[start - 1].isalpha()):
            start -= 1
        found.add(text[start : m.end()])
    return found


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Where characters of two bytes may have been read as single ones: their second byte is in ASCII from @ to ~.

    Only stretches with punctuation of that range, as others are words; ASCII letters in front are included.
    """
    last = 0
    for m in _STRETCH.finditer(text):
        start = m.start()
        while start > last and (text[start - 1].isascii() and text[start - 1].isalpha()):
            start -= 1
        last = m.end()
        if _HAS_TRAIL.search(m[0]) and len(_RUN.findall(m[0])) > 1:
            yield start, last


def stretches_of(text: str) -> set[str]:
    """The distinct stretches that read as text in an encoding of two bytes a character."""
    if text.isascii():
        return set()
    return {s for s in {text[a:b] for a, b in _stretches(text)} if next(stretch_readings(s), None)}


def _bytes(run: str, reader: str) -> bytes | None:
    """The bytes that the reader saw; bytes that it knows no character for stand as controls."""
    try:
        return run.encode(reader)
    except UnicodeEncodeError:
        if reader in WIDE:
            return None
    out = bytearray()
    for ch in run:
        try:
            out += ch.encode(reader)
        except UnicodeEncodeError:
            if not 0x80 <= ord(ch) < 0xA0:
                return None
            out.append(ord(ch))
    return bytes(out)


@lru_cache(64)
def _leads(reader: str) -> frozenset[str]:
    """The characters that a reader of single bytes makes of the first bytes of UTF-8 sequences."""
    return frozenset(bytes([b]).decode(reader, "ignore") or chr(b) for b in range(0xC2, 0xF5))


def utf8_reading(word: str, reader: str) -> tuple[str, list[tuple[str, str]], bool] | None:
    """(restored word, [(garbled sequence, character)], whole) if the word is UTF-8 text seen through the reader.

    Every run must be well-formed UTF-8 throughout but for bytes lost as U+FFFD, then whole is False.
    """
    pairs, whole = [], True
    restored, last = [], 0
    for m in _RUN.finditer(word):
        restored.append(word[last : m.start()])
        last = m.end()
        parts = m[0].split(_LOST)
        for k, part in enumerate(parts):
            if k:
                whole = False
                restored.append(_LOST)
            if not part:
                continue
            if len(parts) == 1 and reader not in WIDE and part[0] not in _leads(reader):
                return None
            raw = _bytes(part, reader)
            if raw is None:
                return None
            at = 0
            while at < len(raw):
                s = _SEQUENCE.match(raw, at)
                if not s:
                    if len(parts) == 1 or raw[at] < 0x80:
                        return None
                    at += 1  # its other bytes were lost
                    restored.append(_LOST)
                    continue
                char = s[0].decode("utf-8")
                if reader not in WIDE and len(part) == len(raw):
                    pairs.append((part[s.start() : s.end()], char))
                else:
                    pairs.append((part, char))
                restored.append(char)
                at = s.end()
    if not pairs:
        return None
    restored.append(word[last:])
    return "".join(restored), pairs, whole


def _script(ch: str) -> str:
    name = unicodedata.name(ch, "")
    return name.split(" ")[0] if name else ""


_KANA_HAN = {"CJK", "HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA", "IDEOGRAPHIC", "FULLWIDTH", "HALFWIDTH"}
_EDGES = {"Pi", "Pf", "Ps", "Pe"}


@lru_cache(1 << 16)
def _traits(ch: str) -> tuple[str, str, bool]:
    """(category, script of a letter, whether the character is odd wherever it stands)."""
    category = unicodedata.category(ch)
    if category[0] not in "LM":
        plain = ch.isascii() or 0x2010 <= ord(ch) <= 0x205E or 0x3000 <= ord(ch) <= 0x303F or 0xFF00 <= ord(ch) <= 0xFF65
        return category, "", not plain
    script = _script(ch)
    odd = script == "HALFWIDTH"
    if script == "CJK":  # ideographs beyond the first level of the common sets
        odd = True
        for encoding, low, high in (("gb2312", 0xB0, 0xD7), ("euc-jp", 0xB0, 0xCF), ("big5", 0xA4, 0xC6)):
            try:
                odd = odd and not low <= ch.encode(encoding)[0] <= high
            except UnicodeEncodeError:
                continue
    return category, "HAN" if script in _KANA_HAN else script, odd


def oddness(word: str) -> int:
    """How improbable the word is as text: symbols and controls in it, capitals after small letters, scripts that
    change from letter to letter, and more than two Latin letters outside ASCII in a row."""
    odd, before, row = 0, None, 0
    for no, ch in enumerate(word):
        category, script, strange = _traits(ch)
        if strange and not (category in _EDGES and no in (0, len(word) - 1)):
            odd += 2 if category == "Cc" else 1
        if script and before and not (ch.isascii() and before[0].isascii()):
            odd += before[0].islower() and ch.isupper()
            odd += script != before[1] and not (category[0] == "M" or {script, before[1]} == {"HAN", "LATIN"})
        row = row + 1 if script == "LATIN" and not ch.isascii() else 0
        odd += row > 2
        before = (ch, script) if script else None
    return odd


def legacy_readings(word: str) -> Iterator[tuple[str, str]]:
    """(hypothesis, restored word) of the readings whose letters outside ASCII are of one script.

    Punctuation, digits and spaces may stand among them. ASCII stays in place, but where two bytes make a
    character and the second one may be an ASCII letter.
    """
    core = _RUN.sub("", word)
    for reader in LEGACY_READERS:
        raw = _bytes(word, reader)
        if raw is None:
            continue
        for writer in LEGACY_WRITERS:
            if writer == reader:
                continue
            try:
                restored = raw.decode(writer)
            except UnicodeDecodeError:
                continue
            if restored == word or (_RUN.sub("", restored) != core and (writer not in PAIRED_WRITERS or reader in WIDE)):
                continue
            traits = [_traits(c) for c in restored if not c.isascii()]
            scripts = {script for _, script, _ in traits if script}
            if len(scripts) == 1 and all(category[0] != "C" for category, _, _ in traits):
                yield f"{writer}>{reader}", restored


def stretch_readings(stretch: str) -> Iterator[tuple[str, str, str]]:
    """(hypothesis, restored stretch, its longest word) in the encodings of two bytes a character."""
    for reader in LEGACY_READERS:
        raw = None if reader in WIDE else _bytes(stretch, reader)
        for writer in PAIRED_WRITERS if raw else []:
            try:
                restored = raw.decode(writer)
            except UnicodeDecodeError:
                continue
            if words := words_of(restored):
                yield f"{writer}>{reader}", restored, max(words, key=lambda w: (len(w), w))


def _weight(word: str, restored: str) -> tuple[int, int]:
    """(characters that bear witness, how much less odd the reading is than the word)."""
    return max(sum(not c.isascii() for c in t) for t in (word, restored)), oddness(word) - oddness(restored)


def _readings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for word in batch.column(0).to_pylist():
            if _HAS_TRAIL.search(word):
                rows += [(word, "legacy", via, restored, [], twin, *_weight(word, restored)) for via, restored, twin in stretch_readings(word)]
                continue
            front, seen = [(word, "")], {word}
            while front:
                behind = []
                for text, chain in front:
                    for reader in UTF8_READERS:
                        found = utf8_reading(text, reader)
                        if found is None:
                            continue
                        restored, pairs, whole = found
                        via = f"{chain}|{reader}" if chain else f"utf-8>{reader}"
                        rows.append((word, "utf8" if whole else "lossy", via, restored, [{"g": g, "c": c} for g, c in pairs], restored, 0, 0))
                        if restored not in seen:
                            seen.add(restored)
                            behind.append((restored, via))
                front = behind
            if len(seen) == 1 and _LOST not in word:
                rows += [(word, "legacy", via, restored, [], restored, *_weight(word, restored)) for via, restored in legacy_readings(word)]
        if rows:
            types = [pa.string()] * 4 + [pa.list_(pa.struct([("g", pa.string()), ("c", pa.string())])), pa.string(), pa.int32(), pa.int32()]
            names = ["word", "kind", "via", "restored", "pairs", "twin", "changed", "gain"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def stripped_lines(text: str) -> set[tuple[str, tuple[str, ...]]]:
    """(digest of the line with a mark for each run of non-ASCII characters, the runs) of the lines that can have twins.

    What a diff puts in front of a line, and blanks around it, don't count.
    """
    found = set()
    for line in [] if text.isascii() else text.split("\n"):
        if not line.isascii():
            bare = _RUN.sub(_MARK, line.strip("+- \t\r"))
            if sum(c.isascii() and c.isalpha() for c in bare) >= LINE_LETTERS:
                found.add((hashlib.blake2b(bare.encode(), digest_size=16).hexdigest(), tuple(_RUN.findall(line))))
    return found


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's distinct words, and its lines' stripped digests and runs, one row each."""
    for batch in batches:
        keys, words, lines, runs = [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if text:
                found, twins = sorted(words_of(text) | stretches_of(text)), sorted(stripped_lines(text))
                keys += [key] * (len(found) + len(twins))
                words += found + [None] * len(twins)
                lines += [None] * len(found) + [digest for digest, _ in twins]
                runs += [None] * len(found) + [list(r) for _, r in twins]
        columns = [pa.array(keys, pa.int64()), pa.array(words, pa.string()), pa.array(lines, pa.string()), pa.array(runs, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "word", "line", "runs"])


@lru_cache(1 << 16)
def _run_reading(run: str, reader: str):
    return utf8_reading(run, reader)


def aligned(garbled: list[str], clean: list[str]) -> Iterator[tuple[str, bool, list[tuple[str, str]]]]:
    """(transformation, whether it accounts for the twins, aligned sequences) for all that apply to the runs of two twins.

    A transformation applies if it can be undone on every run that differs, and accounts for the twins if this gives the clean
    runs. `lost` is the one that leaves U+FFFD in place of characters.
    """
    differing = [(g, c) for g, c in zip(garbled, clean) if g != c]
    if len(garbled) != len(clean) or not differing:
        return
    if all(_LOST in g and set(g) <= {_LOST, *c} for g, c in differing):
        fits = all(_LOST not in c and re.fullmatch(re.escape(g).replace(_LOST, ".{1,4}"), c) for g, c in differing)
        yield "lost", bool(fits), []
    by_bytes = all(len(g) == len(c.encode()) for g, c in differing)
    for reader in UTF8_READERS:
        undone = []
        for g, _ in differing:
            undone.append(_run_reading(g, reader))
            if undone[-1] is None:
                break
        else:
            fits = (by_bytes or reader in WIDE) and all(u[0] == c for u, (_, c) in zip(undone, differing))
            yield reader, fits, [p for u in undone for p in u[1]] if fits else []


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = pa.list_(pa.struct([("g", pa.string()), ("c", pa.string())]))
    for batch in batches:
        via, fits, seqs = [], [], []
        for one, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for garbled, clean in ((one, other), (other, one)):
                for name, fit, found in aligned(garbled, clean):
                    via.append(name)
                    fits.append(fit)
                    seqs.append([{"g": g, "c": c} for g, c in found])
        yield pa.RecordBatch.from_arrays([pa.array(via, pa.string()), pa.array(fits, pa.bool_()), pa.array(seqs, pairs)], ["via", "fits", "pairs"])


def learned_transformations(units: DataFrame) -> tuple[list[str], DataFrame]:
    """(names, sequences g, c): what the twins among the units (key, runs, df) show.

    The names are those of fixed encodings, so there are few, whatever the corpus.
    """
    most = units.groupBy("key").agg(F.max_by("runs", F.struct("df", "runs")).alias("rep"), F.count("*").alias("n")).where("n > 1").select("key", "rep")
    twins = units.join(most.hint("merge"), "key").where("runs <> rep").select("runs", "rep")
    shown = written(spread(twins, "runs").mapInArrow(_compared, "via string, fits boolean, pairs array<struct<g:string,c:string>>"), "shown")
    shares = shown.groupBy("via").agg(F.avg(F.col("fits").cast("double")).alias("share")).where(F.col("share") >= LEARNED_SHARE)
    names = sorted(r.via for r in shares.collect())
    return names, shown.where(F.col("fits") & F.col("via").isin(names)).select(F.explode("pairs").alias("p")).select("p.g", "p.c").distinct()


def garbled_words(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, word) of all documents, and the garbled words: word, kind, via, restored (null where lost).

    kind: utf8 (UTF-8 read as something else, once or repeatedly), legacy (one older encoding read as
    another), lossy (characters replaced by U+FFFD).
    """
    # tables of words shrink to a fraction on disk; joins of two of them must not count on their file size
    grown = lambda df: df.hint("merge")
    texts = documents.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    found = written(texts.mapInArrow(_extracted, "doc_id long, word string, line string, runs array<string>"), "words")
    links = found.where("word is not null").select("doc_id", "word")
    units = written(links.groupBy("word").agg(F.count_distinct("doc_id").alias("df")), "lexicon")
    lexicon = units.where(~F.regexp_like("word", F.lit(_TRAIL)))

    runs = F.regexp_extract_all("word", F.lit(r"([^\x00-\x7f]+)"), F.lit(1))
    bare = F.regexp_replace("word", r"[^\x00-\x7f]+", _MARK)
    in_words = lexicon.where(F.regexp_like("word", F.lit("([A-Za-z].*){%d}" % WORD_LETTERS))).select(F.concat(F.lit("word "), bare).alias("key"), runs.alias("runs"), "df")
    in_lines = found.where("line is not null").groupBy(F.col("line").alias("key"), "runs").agg(F.count_distinct("doc_id").alias("df"))
    names, sequences = learned_transformations(in_words.unionByName(in_lines))

    schema = "word string, kind string, via string, restored string, pairs array<struct<g:string,c:string>>, twin string, changed int, gain int"
    readings = written(spread(units.select("word"), "word").mapInArrow(_readings, schema).join(grown(units), "word"), "readings")
    clean = lexicon.select(F.col("word").alias("twin"), F.col("df").alias("twin_df"))
    joined = written(readings.join(grown(clean), "twin", "left").drop("twin"), "joined")
    once = joined.where(F.col("kind").isin("utf8") & ~F.contains("via", F.lit("|"))).groupBy("via").agg(F.count("twin_df").alias("n"), F.count("*").alias("tries"))
    by_words = [r.via.removeprefix("utf-8>") for r in once.where(F.col("n") >= F.col("tries") * LEARNED_SHARE).collect()]  # no more than there are names
    steps = F.split(F.regexp_replace("via", "^utf-8>", ""), r"\|")
    learned = F.size(F.array_except(steps, F.array(*[F.lit(n) for n in sorted({*names, *by_words})]).cast("array<string>"))) == 0
    structural = joined.where(F.col("kind").isin("utf8", "lossy") & learned)
    confirmed = structural.where("twin_df is not null and kind = 'utf8'")
    mapped = sequences.unionByName(confirmed.select(F.explode("pairs").alias("p")).select("p.g", "p.c")).distinct()

    # characters that are the corpus's own: seen in words that no reading applies to, at least as often as in readings
    characters = lambda c: F.explode(F.array_distinct(F.split(F.regexp_replace(c, r"[\x00-\x7f]+", ""), ""))).alias("c")
    plain = lexicon.join(grown(structural.select("word").distinct()), "word", "left_anti")
    alone = structural.where("twin_df is null")
    read = alone.select("word", "df", characters("restored")).distinct().groupBy("c").agg(F.sum("df").alias("n_read"))
    alphabet = plain.select(characters("word"), "df").groupBy("c").agg(F.sum("df").alias("n_plain"))
    alphabet = alphabet.join(read, "c").where("n_plain >= n_read").select("c")

    spelled = alone.select("word", "kind", "via", "restored", F.posexplode("pairs").alias("no", "p"))
    known = (
        spelled.select("word", "kind", "via", "restored", "no", F.col("p.g").alias("g"), F.col("p.c").alias("c"))
        .join(mapped.withColumn("seen", F.lit(1)), ["g", "c"], "left")
        .join(alphabet.withColumn("own", F.lit(1)), "c", "left")
        .groupBy("word", "kind", "via", "restored")
        .agg(F.min(F.coalesce("seen", "own", F.lit(0))).alias("ok"))
        .where("ok = 1")
    )
    utf8 = confirmed.select("word", "kind", "via", "restored", F.lit(1).alias("twin")).unionByName(
        known.select("word", "kind", "via", "restored", F.lit(0).alias("twin"))
    )
    # a long twin counts by itself where the word is odder than its reading, or as odd and rarer; other readings need the
    # frequencies and other words that confirm the hypothesis, in the corpus or in all documents of the word
    twinned = joined.where("kind = 'legacy' and twin_df is not null").select("word", "via", "restored", "df", "twin_df", "changed", "gain")
    rarer = F.col("twin_df") > F.col("df")
    usual = rarer & (F.length("restored") >= LEGACY_LETTERS)
    tried = joined.where("kind = 'legacy'").groupBy("via").agg(
        F.count_distinct("word").alias("tries"), F.count_distinct(F.when(usual, F.col("word"))).alias("support")
    )
    chance = F.col("tries") * F.col("support_all") / F.col("tries_all")
    whole = tried.agg(F.sum("tries").alias("tries_all"), F.sum("support").alias("support_all"))
    support = tried.crossJoin(F.broadcast(whole)).where((F.col("support") > 1) & (F.col("support") > chance + DEVIATIONS * F.sqrt(chance))).select("via", "support")
    by_hypothesis = F.col("support").isNotNull() & usual
    by_itself = (F.col("changed") >= LONG) & ((F.col("gain") > 0) | ((F.col("gain") == 0) & rarer))
    judged = written(twinned.join(support, "via", "left").withColumn("ok", by_hypothesis | by_itself), "judged")
    proven = judged.where("ok").select("word", "via", "restored", "twin_df")
    places = links.join(grown(proven.select("word", "via")), "word").select("doc_id", "via").distinct()
    other = judged.where("gain >= 0").join(grown(proven.select("word").distinct()), "word", "left_anti")
    other = other.join(grown(proven.select("via").distinct()), "via", "left_semi").select("word", "via", "restored", "df", "twin_df")
    other = other.join(grown(links), "word").join(grown(places), ["doc_id", "via"], "left_semi")
    other = other.groupBy("word", "via", "restored", "df", "twin_df").agg(F.count("*").alias("n")).where("n = df").select(proven.columns)
    legacy = proven.unionByName(other).select("word", F.lit("legacy").alias("kind"), "via", "restored", F.lit(1).alias("twin"), "twin_df")

    # learned like the others: where twins have letters, U+FFFD beside letters stands for one
    lost = lexicon.where(F.regexp_like("word", F.lit(r"[\p{L}]�|�[\p{L}]")) & F.lit("lost" in names))
    shape = lambda c: F.regexp_replace(c, r"[^\x00-\x7f]", _LOST)
    full = lexicon.where(~F.contains("word", F.lit(_LOST))).groupBy(shape("word").alias("shape")).agg(F.max_by("word", "df").alias("restored"))
    only = ~F.regexp_like("word", F.lit(r"[^\x00-\x7f�]"))  # else what is left of the word isn't its text
    lost = lost.withColumn("shape", F.when(only, shape("word"))).join(full, "shape", "left")
    lost = lost.select("word", F.lit("lossy").alias("kind"), F.lit("lost").alias("via"), "restored", F.lit(0).alias("twin"))

    every = utf8.unionByName(legacy, True).unionByName(lost, True)
    order = F.struct(
        F.col("restored").isNotNull(), "twin", F.when(F.col("kind") == "utf8", 2).when(F.col("kind") == "legacy", 1).otherwise(0), F.coalesce("twin_df", F.lit(0)), -F.length("restored"), "via"
    )
    best = every.groupBy("word").agg(F.max_by(F.struct("kind", "via", "restored"), order).alias("b")).select("word", "b.*")
    return links, written(best, "garbled")


def garbled_documents(documents: DataFrame) -> DataFrame:
    """doc_id of each document that holds a garbled word. Null and empty texts hold none; an empty table gives no rows."""
    links, garbled = garbled_words(documents)
    return links.join(garbled.select("word").hint("merge"), "word", "left_semi").select("doc_id").distinct()


def restored_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_restored, text: garbled documents with their garbled words put right.

    n_words counts the distinct garbled words, n_restored those whose original is known; text has these
    replaced, the others stay as they are.
    """
    links, garbled = garbled_words(documents)
    fixes = links.join(garbled.hint("merge"), "word").groupBy("doc_id").agg(F.collect_list(F.struct("word", "restored")).alias("fixes"))
    rows = documents.select(F.col("doc_id").cast("long"), "text").join(fixes, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, fixed in zip(batch.column("text").to_pylist(), batch.column("fixes").to_pylist()):
                table, met, parts, last = {f["word"]: f["restored"] for f in fixed}, set(), [], 0

                def words(a: int, b: int) -> None:
                    last = a
                    for m in _WORD.finditer(text, a, b):
                        start = m.start()
                        while start > last and (text[start - 1].isascii() and text[start - 1].isalpha()):
                            start -= 1
                        word = text[start : m.end()]
                        if word in table:
                            met.add(word)
                        parts.extend([text[last:start], table.get(word) or word])
                        last = m.end()
                    parts.append(text[last:b])

                for a, b in _stretches(text):
                    if table.get(text[a:b]):  # its words are parts of it
                        words(last, a)
                        met.add(text[a:b])
                        parts.append(table[text[a:b]])
                        last = b
                words(last, len(text))
                out.append((len(met), sum(table[w] is not None for w in met), "".join(parts)))
            n_words, n_restored, texts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_restored, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_restored", "text"]
            )

    return rows.mapInArrow(run, "doc_id long, n_words long, n_restored long, text string")
