"""The automaton against plain edit distances; scores on fixtures and held-out rows."""

import random
import zlib

from agroplan.llm import queries, toxicity

LABELS = "doc_id long, toxic int, lang string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_op12_automaton():
    draw = random.Random(2)
    terms = [("scum", False), ("moron", False), ("loser", False), ("losing", True), ("worthless", False), ("disgusting", True), ("mor", True)]
    machine = toxicity.Automaton(terms)
    words = ["", "mor", "moron", "oron", "moronic", "worthles", "wrthlss", "wortlhess", "disgustingly", "disgustngly", "dsgstingly", "lloser", "los", "scumm"]
    for _ in range(3000):
        word = list(draw.choice(terms)[0])
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(word) + 1)
            word[at : at + draw.randrange(2)] = draw.choice(["", "e", "o", "s", "q"])
        words.append("".join(word) + draw.choice(["", "", "ly", "xyz"]))
    for word in words:
        wanted = []
        for t, (letters, stem) in enumerate(terms):
            least = min((distance(letters, word[:k]) for k in range(1, len(word) + 1)), default=99) if stem else distance(letters, word)
            if word and least <= toxicity.allowed(letters):
                wanted.append((t, least))
        assert list(machine.hits(word)) == wanted, word
    assert len(machine.states) < 5000


def test_op12_context():
    line = 'He said: "you are an idiot" and left. Idiot, he is.'
    spans = [(m.start(), m.end()) for m in toxicity._WORD.finditer(line) if m[0].lower() == "idiot"]
    assert [toxicity.quoted(line, *s) for s in spans] == [True, False]
    for text, inside in (("so „ein Idiot“ dann", True), ("« quel Idiot » dit", True), ("> an Idiot", True), ("a “nice” Idiot “x”", False), ('an "Idiot\nend"', False), ("Idiot", False)):
        at = text.index("Idiot")
        assert toxicity.quoted(text, at, at + 5) is inside, text
    weigh = lambda text: toxicity.context(text, text.index("idiot"), text.index("idiot") + 5)[1]
    assert weigh('the word "idiot" is a term') < weigh("the idiot left") < weigh("you idiot, leave")


def prose(draw, n):
    return [draw.choice("harvest rose field of the and when cold night water stem box plan grower over valley".split()) for _ in range(n)]


def corpus():
    """Documents with planted abuse (stems and whole words), quoted abuse, odd rows; and labels."""
    draw, rows, labels = random.Random(8), [], []
    for i in range(1500):
        words, toxic = prose(draw, draw.randrange(40, 120)), i % 5 == 0
        if toxic:
            for _ in range(3):
                words[draw.randrange(len(words))] = draw.choice(["moron", "worthless", "clownish", "trashlo", "trashva", "trashmi"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), "xx"))
    return rows, labels


def test_op12_scores(spark):
    rows, labels = corpus()
    draw, base = random.Random(9), 10_000
    probe = lambda *words: " ".join([*prose(draw, 20), *words, *prose(draw, 20)])
    odd = [None, "", "...", probe("morron", "wortless", "moon"), probe("moron", "worthless"), probe('"moron', 'worthless"'), probe("trashing", "trashzzz"), ("rose " * 300_000) + "moron " + "worthless " * 9, probe()]
    rows += [(base + i, t) for i, t in enumerate(odd)] + [(None, odd[4]), (3, odd[4])]
    labels += [(None, 1, "x"), (base, None, "x"), (base + 1, 7, "x"), (3, 0, "x"), (3, 0, "y"), (99_999, 1, "x")]
    docs = spark.createDataFrame([(i, t, "x", 1.0, 2, "z") for i, t in rows], "doc_id long, text string, toxic string, score double, share int, hits string").repartition(4)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    assert {"moron", "worthless"} <= {t for t, stem in model.terms if not stem} and any("trash".startswith(t[:5]) and stem for t, stem in model.terms)
    out = toxicity.score_documents(docs, model).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out if r.doc_id is not None and r.doc_id >= base}
    score = lambda i: by[base + i].score
    assert score(0) == score(1) == score(2) and score(0) < 0.1 and by[base].n_words == 0
    assert score(4) > 0.9 and score(3) > score(8) and score(5) < score(4) and score(6) > 0.7 and score(7) > score(8)
    assert {h.term for h in by[base + 3].hits} == {"moron", "worthless"} and all(h.edits == 1 for h in by[base + 3].hits)
    assert [r.score for r in out if r.doc_id is None] == [score(4)]
    long_ = by[base + 7]
    assert long_.n_words == 300_010 and len(long_.hits) == 10 and (odd[7])[long_.hits[0].begin : long_.hits[0].end] == "moron"
    held = [r for r in out if r.doc_id is not None and r.doc_id < 1500 and r.doc_id != 3 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.7) == (r.doc_id % 5 == 0) for r in held) >= 0.99 * len(held) > 300


def test_op12_held_out_labels_are_not_read(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows[:600], "doc_id long, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, z) for i, y, z in labels]
    one, two = (toxicity.fit(docs, spark.createDataFrame(x, LABELS)) for x in (labels, turned))
    assert one == two and one.terms


def test_op12_empty(spark):
    docs = spark.createDataFrame([(1, "moron"), (2, None)], "doc_id long, text string")
    none = toxicity.fit(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    assert toxicity.fit(docs.limit(0), spark.createDataFrame([(1, 1, "x")], LABELS)) == toxicity.Toxicity()
    assert toxicity.score_documents(docs.limit(0), none).count() == 0


def test_op12_held_out(spark):
    data = "/root/testdata/sf0.01"
    out = queries.op12_toxicity(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic) and sum(r.predicted for r in clean) <= 0.02 * len(clean)
