"""Review-text tokens with built-in string functions; no Python worker is involved."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from orderloom.functions.clean import col

# Three or more letters, plain or in the accented range á-ú.
TOKEN_PATTERN = "([a-zA-Zá-úÁ-Ú]{3,})"

# Accented letters of the token range and their plain forms.
ACCENTED = "áâãäåçèéêëìíîïñòóôõöùú"
PLAIN = "aaaaaceeeeiiiinooooouu"

# Portuguese function words and words too common in shop reviews to tell anything.
PORTUGUESE_STOP = (
    "a o as os um uma uns umas de do da dos das em no na nos nas por pra para com sem sob sobre "
    "e ou mas que se porque como quando onde qual quais eu tu ele ela vos eles elas voce voces meu minha "
    "seu sua este esta isso esse essa aquele aquela ao aos nao sim ja ainda muito muita muitos muitas mais menos "
    "bem mal tudo nada algum alguma todo toda todos todas ser estar ter fazer foi era estao sao tem tinha "
    "ficou chegou veio vou vai so ate depois antes agora "
    "comprei produto produtos compra loja entrega recebi recebido pedido item itens dia dias prazo data"
).split()

# Common English function words of three letters or more.
ENGLISH_STOP = (
    "the and for are but not you all any can had her was one our out has him his how its may now "
    "she too use who why did get let per than that this with have from they been were will would "
    "there their what when where which while your about after again also because before being below "
    "between both could does doing down during each few further here hers into just more most myself "
    "nor off once only other over own same should some such them then these those through under until "
    "very yours"
).split()

STOP_WORDS = tuple(sorted(set(PORTUGUESE_STOP) | set(ENGLISH_STOP)))


def strip_accents(c: Column | str) -> Column:
    return F.translate(col(c), ACCENTED, PLAIN)


def raw_words(c: Column | str) -> Column:
    """Lower-case words of at least three letters, accents kept, stop words included."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(TOKEN_PATTERN), F.lit(0))


def tokens(c: Column | str, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case words of at least three letters, accents removed, stop words dropped."""
    words = F.transform(raw_words(c), strip_accents)
    stop = list(stop)
    if not stop:
        return words
    return F.filter(words, lambda w: ~w.isin(stop))


def bigrams(words: str) -> Column:
    """Neighbouring pairs ``"a b"`` of a token array column; empty for fewer than two tokens.

    Takes a column name, not an expression: the array is read several times.
    """
    w = F.col(words)
    pairs = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, F.lit(1), pairs), F.slice(w, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b))


def review_field(title: Column | str, message: Column | str, which: str = "both") -> Column:
    """Title, message or both joined by a blank; NULL when nothing is left."""
    parts = {"title": [title], "message": [message], "both": [title, message]}[which]
    joined = F.concat_ws(" ", *[F.nullif(F.trim(col(p)), F.lit("")) for p in parts])
    return F.nullif(joined, F.lit(""))
