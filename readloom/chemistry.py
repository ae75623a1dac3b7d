"""Read layouts of library chemistries."""

from __future__ import annotations

import re
from dataclasses import dataclass


def parse_structure(text: str) -> list[tuple[str, int]]:
    """[(code, length)]: B barcode, L linker, U UMI, X and T skipped."""
    return [(c, int(n)) for c, n in re.findall(r"([BLUXT])(\d+)", text)]


def read_structure(read_format: str) -> str:
    """bc:0:16,um:17:28 -> 17C12M+T; ends count."""
    parts = sorted((p.split(":") for p in read_format.split(",")), key=lambda p: int(p[1]))
    codes = {"bc": "C", "um": "M"}
    return "".join(f"{int(e) - int(s) + 1}{codes[k]}" for k, s, e in parts if k in codes) + "+T"


def region(include_introns: bool) -> str:
    """The feature that reads are counted on."""
    return "transcript" if include_introns else "exon"


def five_prime(ratio: float | None) -> bool | None:
    """Whether reads lie at the 5' end, from the ratio of mean coverage at the 5' to that at the 3' end; None where that does not tell."""
    return None if ratio is None or 0.5 <= ratio <= 2 else ratio > 2


@dataclass(frozen=True)
class Chemistry:
    """A layout with what is needed to read barcodes from it.

    With shift the layout begins behind the first base of `pattern`, which must lie in the first seven bases. match_type
    has for each barcode segment the mismatches allowed (the last counts for further ones): 1 takes every whitelist entry at one substitution,
    more takes those at the least distance up to it. Adapters are (bases, end 3 or 5) for the first and the second read.
    """

    structure: str
    shift: bool = False
    pattern: str = ""
    match_type: tuple[int, ...] = (1,)
    adapters_1: tuple[tuple[str, str], ...] = (("AAAAAAAAAAAA", "3"),)
    adapters_2: tuple[tuple[str, str], ...] = (("AAAAAAAAAAAA", "3"),)
    five_prime: bool | None = False

    @property
    def segments(self) -> list[tuple[str, int]]:
        return parse_structure(self.structure)

    def match(self, nth: int) -> int:
        return self.match_type[min(nth, len(self.match_type) - 1)]


#: Sequencing primers, template switch oligo and poly tails, and the layouts built from them.
SP2, SP1, SP2_REVERSED, TSO = "GATCGGAAGAGCACACGTCTGAACTCCAGTCAC", "ACACTCTTTCCCTACACGACGCTCTTCCGATCT", "GTGACTGGAGTTCAGACGTGTGCTCTTCCGATC", "AAGCAGTGGTATCAACGCAGAGTACATGG"
POLY_A, POLY_T = "AAAAAAAAAAAA", "TTTTTTTTTTTT"
CHEMISTRIES = {
    "DDV1": Chemistry("B8X8B8X10B8U8", True, "A", (1,), ((SP2, "3"), (SP1, "5"), (POLY_T, "5")), ((SP2_REVERSED, "5"), (POLY_A, "3"), (TSO, "5"))),
    "DDV2": Chemistry("B17U12", False, "", (1,), ((SP2, "3"), (SP1, "5"), (POLY_T, "5")), ((SP2_REVERSED, "5"), (POLY_A, "3"), (TSO, "5"))),
    "DDVS": Chemistry("B17U12X24B10", False, "", (1, 3), ((SP2, "3"), (SP1, "5"), (POLY_T, "5")), ((TSO, "5"), (SP2_REVERSED, "5"), (POLY_A, "3"))),
    "DD5V1": Chemistry("B17U12", False, "", (1,), ((SP1, "5"), (SP2, "3")), ((SP2_REVERSED, "5"), (POLY_T, "5"), ("CCCATATAAGAAA", "3"), (TSO, "5")), True),
    "MM": Chemistry("B8X8B8X10B8U8", True, "A", (1,), ((SP1, "5"), (SP2, "3"), (POLY_T, "5")), ((SP2_REVERSED, "5"), (POLY_A, "3"), (POLY_A, "5"), (TSO, "5"))),
    "MM-D": Chemistry("B8X8B8X10B8U8", True, "A"),
    "DD-Q": Chemistry("B17U12X17", False, "", (1,), ((SP2, "3"), (SP1, "5")), ((TSO, "5"), (SP2_REVERSED, "5")), None),
}
#: Least lengths of the two reads after trimming.
LEAST_1, LEAST_2 = 20, 60
