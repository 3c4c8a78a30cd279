"""What the findings of round 3 named in the training-data operators."""

import numpy as np
import public_tokenizers

from millrace.llm import tokens
from millrace.llm.common import Texts


def test_pieces_are_learned_once_for_cases_and_signs():
    """op4: a word is one piece in either case and before any sign, and ids are those of whole texts, whatever composes or is an added token."""
    enc = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Word word$$$ word! WORD. WoRd", "élan élan$$ Élan. é×. ÉÉ!", "H̱ ẖ T̈. J̌ İ İ! W̊, ẙ", "it's IT'S we'RE don't. x'.S", "A≠b É́. a<|endoftext|>b.C", "a…. b。. c÷. d×! ﬁ. ß! ſ. K."]
    for some in ([x] for x in [*texts, "x<|ENDOFTEXT|>.y <|EndOfText|>! A", "", "A" * 3000 + "!" * 50]):
        data = [x.encode() for x in some]
        whole = Texts(np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0, *map(len, data)]))
        assert enc.encode(whole)[0].tolist() == enc.whole(some)[0], some
    enc.cache = tokens.Cache()
    data = texts[0].encode()
    enc.encode(Texts(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)])))
    assert set(enc.cache.young) == {b"word", b"$$$", b"!", b"."}
