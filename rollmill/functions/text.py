"""Text clean-up for the line format."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that would break a line, and the edge characters that are trimmed (<= U+0020).
LINE_BREAKERS = "\t\n\r\x00\\"
EDGE_CHARACTERS = "".join(map(chr, range(0x21)))


def clean_text(text: Column) -> Column:
    """Delete line breakers, then trim control characters and blanks from both ends."""
    return F.trim(F.translate(text, LINE_BREAKERS, ""), F.lit(EDGE_CHARACTERS))
