"""The operators' encoder against the unmodified library: added tokens of the file."""

from tests.llm.test_tokens import TEXTS, check_pieces
from tidemark.llm import packing
from tidemark.llm.token_encoder import TokenEncoder, default_path

MARKED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x  y", "x<|endoftext|>", "a  <|endoftext|>  b", "\n<|endoftext|>\n\nc d", "<|endoftext|", "<|endoftext|>'s it"]


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_encoder_equals_the_unmodified_library():
    ids = library()
    assert ids(MARKED[0]) == [64, 220, 50256, 275]
    for x in (MARKED + TEXTS) * 2:
        assert TokenEncoder(default_path()).encode_text(x) == ids(x), x


def test_packing_of_added_tokens(spark):
    rows = list(enumerate(MARKED))
    check_pieces(rows, packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), default_path()).collect(), library())
