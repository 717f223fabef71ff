"""The unknown lines that licences are told from are those of all texts."""

from affinia.llm import licenses


def test_lines_of_all_texts_are_learned_from(spark, monkeypatch):
    learned, vectors = [], licenses.vectors
    monkeypatch.setattr(licenses, "vectors", lambda rows, known: learned.append(rows) or vectors(rows, known))
    word = "abcdefghij"
    texts = [(i, f"the public {word[i % 10]}{word[i // 10 % 10]}{word[i // 100 % 10]}{word[i // 1000]} domain of letters") for i in range(2500)]
    texts += [(9000, "plain words\n" * 4000 + "all rights are held here")]  # longer than any text of a sample
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    known = licenses.vocabulary(spark)
    rows = licenses.candidates(licenses.lines(docs), known).select("doc_id", "line_no", "words")
    n = rows.select("words").distinct().count()
    assert n > 2000
    licenses.train(rows, known)
    unknown = learned[0].filter("label = 0")
    assert unknown.groupBy().sum("weight").first()[0] == n + 20
