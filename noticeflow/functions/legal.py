"""Company legal forms: stripping and splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BOUNDARY, SPACE, clean_by_format

# --- fixed values: legal-form endings, tried in this order -------------------
# Letters may be parted by blanks and dots. The first entry differs between
# stripping and splitting; the others are shared.
STRIP_FIRST = r" S[ \.]*A[ \.]* DE"
SPLIT_FIRST = r" S[ \.]*A[ \.]*DE"
ENDINGS = [
    r" S[ \.]* EN C[ \.]*",
    r" S[ \.]* EN N[ \.]*C[ \.]*",
    r" S[ \.]*DE R[ \.]*L[ \.]*",
    r"DE C[ \.]*V[ \.]*",
    r"DE R[ \.]*L[ \.]*",
    r"EN C[ \.]* POR A",
    r" C[ \.]*S[ \.]*",
    r"( S[ \.]*C[ \.]*)$",
    r" S[ \.]*O[ \.]*F[ \.]*O[ \.]*M[ \.]*",
    r" S[\. ]*C[\. ]*",
    r" C[\. ]*V[ \.]*",
    r" R[\. ]*L[ \.]*",
    r" C[ \.]*S[ \.]*",
    r" S[ \.]*A[ \.]*P[ \.]*I[ \.]*",
    r" S[ \.]*A[ \.]*A[\.]*",
    r" S[ \.]*A[ \.]*C[\.]*",
    r" S[ \.]*A[ \.]*S[ \.]*",
]

# --- fixed value: abbreviated denominations after white space ----------------
DENOMINATION = r"((\s)((((B[ ]{0,1})((V)))|((I[ ]{0,1})(((N[ ]{0,1})((C)))))|((P)(( DE | EN | )?)((C)))|(M[ ]{0,1}I)|((I)(( DE | EN | )?)((B[ ]{0,1}P)|(A[ ]{0,1}((S[ ]{0,1}P)|(P)|(S)))))|((F)(( DE | EN | )?)((A)|(C)))|((C[ ]{0,1})((E[ ]{0,1}L)|((POR )?A)))|((A)(( DE | EN | )?)((L(( DE | )?(P[ ]{0,1}R)))|(R(( DE | )?(I[ ]{0,1}C))?)|(B[ ]{0,1}P)|(P(([ ]{0,1}[ELN]))?)|([ACG])))|((U)(( DE | )?)(((S)(( DE | )?(P[ ]{0,1}R)))|(E(([ ]{0,1}C))?)|(C)))|((S[ ]{0,1}O[ ]{0,1}F[ ]{0,1})(((O[ ]{0,1})(([LM](([ ]{0,1}(E[ ]{0,1}(N[ ]{0,1})?R)))?)))|(I[ ]{0,1}P[ ]{0,1}O)))|((S[ ]{0,1}A)(([ ]{0,1}B)|([ ]{0,1}P[ ]{0,1}I)|([ ]{0,1}P[ ]{0,1}I[ ]{0,1}B))?)|((S)((( DE | EN | )?)((I((( DE | EN | )?)((I((( DE | )?(D(( PARA | )?(P[ ]{0,1}M))?))?))|(O[ ]{0,1}L[ ]{0,1})|(R[ ]{0,1}V[ ]{0,1})|(C[ ]{0,1}V)|(R[ ]{0,1}S)|(R[ ]{0,1}[IL])|(C[ ]{0,1}))?))|((C)((( DE | EN | )?)((C[ ]{0,1}V)|(([CP])((( DE | )?((B[ ]{0,1}S)|(S)))|([ ]{0,1}([RC])))?)|(A[ ]{0,1}P)|((POR )?A)|(R[ ]{0,1}[LVS])|(R[ ]{0,1}I)|([SPUL]))?))|(G[ ]{0,1}C)|(N[ ]{0,1}C)|((S[ ]{0,1})(S))|((P)(([ ]{0,1}(A|R)))?)|(L)))))|((S( DE | DE| )?R[ ]{0,1}L)|(DE |DE| )?((R[ ]{0,1}L)|(I[ ]{0,1}P)|(C[ ]{0,1}V)|(R[ ]{0,1}S)|(R[ ]{0,1}I)|(R[ ]{0,1}V)|(O[ ]{0,1}L)|(A[ ]{0,1}R[ ]{0,1}T)|(M[ ]{0,1}I)|((E[ ]{0,1}(N[ ]{0,1})?R)))))(\b))"  # noqa: E501


def endings_pattern(first: str) -> str:
    """One capturing alternation of all endings."""
    return "(" + "|".join([first, *ENDINGS]) + ")"


def _java(pattern: str) -> str:
    """The same pattern with Unicode classes, and ``$`` before ``\\n`` only."""
    return "(?d)" + pattern.replace(r"\s", SPACE).replace(r"\b", BOUNDARY)


def strip_legal_form(name: Column) -> Column:
    """Upper-cased name without its legal form; other names come back unchanged."""
    upper = F.upper(name)
    endings = "(?iu)" + _java(endings_pattern(STRIP_FIRST))
    bare = F.regexp_replace(upper, "(?iu)" + _java(DENOMINATION), "")
    return F.when(upper.rlike(endings), F.regexp_replace(bare, endings, "")).otherwise(name)


def split_legal_form(name: Column) -> Column:
    """Pieces of a cleaned name, cut at its legal forms, which are kept as pieces."""
    cleaned = clean_by_format(name, "nombres")
    endings = _java(endings_pattern(SPLIT_FIRST))
    cuts = F.regexp_extract_all(cleaned, F.lit(endings), 1)
    finals = F.regexp_extract_all(cleaned, F.lit(endings), 2)
    between = F.split(cleaned, endings, -1)
    pieces = F.flatten(
        F.transform(between, lambda s, i: F.array(s, F.get(cuts, i), F.get(finals, i)))
    )
    kept = F.filter(pieces, lambda s: s.isNotNull() & (s != ""))
    return F.transform(kept, lambda s: F.regexp_replace(s, _java(DENOMINATION), ""))
