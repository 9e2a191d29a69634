import numpy as np
from tokenizers import Tokenizer

from ledgerlake.llm.token_output import SAMPLE_CHARS, sample_ids, write_token_files
from ledgerlake.llm.tokens import WORD_BPE, vocabulary

HEAD = "plain words at the start of it " * (SAMPLE_CHARS // 25)
TAIL = "quite another passage follows near its end " * (SAMPLE_CHARS // 25)


def serialized(text):
    tokenizer = Tokenizer.from_file(vocabulary(WORD_BPE))
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_later_parts_of_long_texts_shape_the_dictionary(spark, tmp_path):
    assert len(HEAD) > SAMPLE_CHARS
    docs = frame(spark, [(k, f"{k} {HEAD}{TAIL}") for k in range(60)])
    path = str(tmp_path / "tokens")
    write_token_files(docs, path, vocabulary(WORD_BPE), end_id=1, id_width=2)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    assert serialized("another passage follows near") in dictionary


def test_slices_are_bounded_and_short_texts_whole(spark):
    rows = [(k, "few words") for k in range(5)] + [(9, None), (10, ""), (11, HEAD + TAIL)]
    samples = sample_ids(frame(spark, rows), vocabulary(WORD_BPE), np.dtype("<u2"))
    assert samples.count(serialized("few words")) == 5
    assert len(samples) == 6
    assert max(map(len, samples)) < len(serialized(HEAD + TAIL))
