"""What the pipeline encodes is verified against SentencePiece."""

from affinia.llm import pieces


class Odd(pieces.Codec):
    """Its rebuilt tokenizer gives a wrong id for one word."""

    def __init__(self, data, *options):
        super().__init__(data, *options)
        rest = self.rest

        class Wrong:
            def encode_batch_fast(self, words, **options):
                found = rest.encode_batch_fast(words, **options)
                return [type("E", (), {"ids": [5] if "wrong" in w else e.ids}) for w, e in zip(words, found)]

            def decode_batch(self, *args, **options):
                return rest.decode_batch(*args, **options)

        self.rest = Wrong()


def test_encoded_texts_have_the_ids_of_sentencepiece(spark):
    texts = ["right words", "a wrong word", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    run = pieces.encode(docs)
    codec = Odd(pieces.load(), pieces.ENCODE_CACHE)
    want = codec.reference([t or "" for t in texts])
    assert [list(r.ids) for r in run.orderBy("doc_id").collect()] == want
    assert [same for _, _, same in codec.verified(["right words", "a wrong word"])] == [True, False]
    got = pieces.encode_verified(codec, [t or "" for t in texts])
    assert got == want
