"""The stemmer against the examples of the published algorithm."""

import pytest

from tarn.functions.stemming import stem_word

PUBLISHED = """
caresses caress   ponies poni   ties tie   cats cat   feed feed   agreed agre   plastered plaster
bled bled   motoring motor   sing sing   conflated conflat   troubled troubl   sized size
hopping hop   tanned tan   falling fall   hissing hiss   fizzed fizz   failing fail   filing file
happy happi   sky sky   relational relat   conditional condit   rational ration   valenci valenc
digitizer digit   conformabli conform   radicalli radic   differentli differ   vileli vile
analogousli analog   vietnamization vietnam   predication predic   operator oper
feudalism feudal   decisiveness decis   hopefulness hope   callousness callous   formaliti formal
sensitiviti sensit   sensibiliti sensibl   triplicate triplic   formative form   formalize formal
electriciti electr   electrical electr   hopeful hope   goodness good   revival reviv
allowance allow   inference infer   airliner airlin   gyroscopic gyroscop   adjustable adjust
defensible defens   irritant irrit   replacement replac   adjustment adjust   dependent depend
adoption adopt   homologou homolog   communism commun   activate activ   angulariti angular
homologous homolog   effective effect   bowdlerize bowdler   probate probat   rate rate
cease ceas   controll control   roll roll   adventure adventur   children children
comedy comedi   fantasy fantasi   romance romanc   drama drama   crime crime   thriller thriller
mystery mysteri   documentary documentari   musical music   animation anim   western western
dying die   spied spi   died die   enjoy enjoy   july juli   may may   generally gener
""".split()


@pytest.mark.parametrize("word,expected", zip(PUBLISHED[::2], PUBLISHED[1::2]))
def test_published_examples(word, expected):
    assert stem_word(word) == expected


def test_short_words_and_case():
    assert [stem_word(w) for w in ("", "a", "IS", "Running")] == ["", "a", "is", "run"]
