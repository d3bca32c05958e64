"""Words of texts, as expressions, and the word lists shared by the text operators."""

from pyspark.sql import Column, functions as F

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
you were all we there been their has if so its into than
der die das und zu den von mit sich des auf für ist im dem nicht ein eine als auch es werden aus er hat dass sie
nach wird bei einer um am sind noch wie so zum
le la les de un une et à en que qui dans pour pas au sur ne se ce il par plus avec son est aux du sont mais ou nous
cette elle ont
el los las y del con una su al lo como más pero sus este sí porque esta entre cuando muy sin sobre también me hasta
""".split())

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Runs of ASCII characters that are neither letter nor digit.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Words of ASCII letters, digits and all else beyond ASCII, A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")
