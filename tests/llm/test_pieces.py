import sentencepiece
from pyspark.sql import functions as F

from ledgerloom.llm.pieces import MODEL, SPACE, Pieces, _units, decode, encode, encode_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_against_library(spark, small):
    vocabulary, model = Pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [(10_000, "Hello  world\n foo\tbar ¡é 漢\U0001F600  ", None, None, 0), (10_001, "", None, None, 0), (10_002, None, None, None, 0),
             (10_003, "   ", None, None, 0), (None, "the the the", None, None, 0), (10_005, "a" * 300, None, None, 0), (10_001, "", None, None, 0)]
    df = docs.unionByName(spark.createDataFrame(extra, SCHEMA)).withColumn("word", F.lit(1)).repartition(5)
    out = encode(df, vocabulary, batch_bytes=100_000, shard_bytes=50_000)
    rows = out.withColumn("text", decode(F.col("ids"), vocabulary)).collect()
    texts = [(r.doc_id, r.text) for r in df.collect()]
    assert len(rows) == len(texts)
    want = dict(texts)
    for r in rows:
        assert r.text == want[r.doc_id]
        assert r.ids == (None if r.text is None else model.encode(r.text))
    assert encode(df.limit(0), vocabulary).count() == 0


def test_unit_of_any_length(spark):
    vocabulary, model = Pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [" " * 600_000, "x" + "-" * 600_000 + "y", "a" * 255, "ab " + "a" * 256, "a" * 257 + "=" * 1000 + "\U0001F600" * 300]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA)
    assert max(len(u) for u in _units(SPACE + texts[0].replace(" ", SPACE), vocabulary.joints).to_pylist()) > 600_000
    out = encode(df, vocabulary)
    rows = {r.doc_id: r for r in out.withColumn("text", decode(F.col("ids"), vocabulary)).collect()}
    for i, text in enumerate(texts):
        assert rows[i].text == text
        assert rows[i].ids == model.encode(text)


def test_viterbi(spark):
    rows = [("a", 0, -1.0), ("b", 1, -1.0), ("ab", 2, -1.5), ("ba", 3, -0.2), ("abb", 4, -3.2)]
    vocabulary = Pieces(tuple(rows), (), 9, ("61", "62", "6162", "6261", "616262", "", "", "", "", ""), "unigram")
    words = ["a", "ab", "abb", "abba", "babab", "xa", "bbbb"]
    score = {p: s for p, _, s in rows}

    def best(word):
        table = [(0.0, [])] + [None] * len(word)
        for end in range(1, len(word) + 1):
            options = []
            for start in range(end):
                piece = word[start:end]
                if piece in score or len(piece) == 1:
                    options.append((table[start][0] + score.get(piece, -1e9), -start, table[start][1] + [{p: i for p, i, _ in rows}.get(piece, 9)]))
            top = max(options, key=lambda o: o[:2])
            table[end] = (top[0], top[2])
        return table[-1][1]
    got = {r.word: r.ids for r in encode_words(spark.createDataFrame([(w,) for w in words], "word string"), vocabulary).collect()}
    assert got == {w: best(w) for w in words}


def test_units_are_independent_of_their_neighbours():
    import sentencepiece

    model, joints = sentencepiece.SentencePieceProcessor(model_file=MODEL), Pieces.load(MODEL).joints
    for text in ("a", "two words,\n\nnew.Line  $$$ x", "naïve 漢字かな 😀😀 \t end ", "abc " * 100_000):
        marked = SPACE + text.replace(" ", SPACE)
        units = _units(marked, joints).to_pylist()
        assert "".join(units) == marked
        ids = [i for u in units for i in spelled(model, u)]
        assert ids == model.encode(text)


def spelled(model, unit, memory={}):  # noqa: B006
    """The pieces of a unit alone, without the space that the library puts in front of a text."""
    if unit not in memory:
        memory[unit] = model.encode(unit[1:]) if unit[0] == SPACE and unit[1:2] not in ("", SPACE) else model.encode("\n" + unit)[len(model.encode("\n")):]
    return memory[unit]
