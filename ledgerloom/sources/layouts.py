"""Record layouts of the input files. All positions are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerloom.functions.fixedwidth import Field, SignedField

# Split of the 18-character Id. CGL asks for ten characters from position 9.
KEY_FIELDS = [
    Field("BRANCH_CODE", 1, 5),
    Field("CURRENCY", 6, 3),
    Field("CGL", 9, 10),
]


@dataclass(frozen=True)
class GlLayout:
    """Where a ledger line keeps its Id and its two amounts.

    Both amounts have one length, of at most 18 characters, and ``decimals`` implied
    decimal places, at most 3. The character with the last digit and the sign is the
    last of the amount, unless ``local_sign`` or ``foreign_sign`` says where it stands.
    """

    currency: Field = Field("currency_code", 48, 3)
    key: Field = Field("Id", 51, 18)
    local_amount: Field = Field("lcyAmt", 116, 17)
    foreign_amount: Field = Field("fcyAmt", 133, 17)
    local_currency: str = "INR"
    key_fields: list[Field] = field(default_factory=lambda: list(KEY_FIELDS))
    local_sign: Field | None = None
    foreign_sign: Field | None = None
    decimals: int = 3

    def __post_init__(self) -> None:
        if self.local_amount.length != self.foreign_amount.length or not 1 < self.amount_length <= 18:
            raise ValueError("both amounts must have the same length, of 2 to 18 characters")
        if not 0 <= self.decimals <= 3:
            raise ValueError("amounts have at most 3 decimal places")

    @property
    def amount_length(self) -> int:
        return self.local_amount.length

    @property
    def amounts(self) -> tuple[Field | SignedField, Field | SignedField]:
        """The local and the foreign amount."""
        pairs = [(self.local_amount, self.local_sign), (self.foreign_amount, self.foreign_sign)]
        return tuple(SignedField(a, s) if s else a for a, s in pairs)


@dataclass(frozen=True)
class FeedLayout:
    """A source whose sign is a character of its own."""

    name: str
    key: Field
    amount: Field
    sign: Field
    decimals: int


FEEDS = {
    "INV": FeedLayout("INV", Field("Id", 200, 18), Field("amount", 30, 17), Field("sign", 47, 1), 3),
    "BOR": FeedLayout("BOR", Field("Id", 105, 18), Field("amount", 27, 17), Field("sign", 44, 1), 3),
    # The amount runs from character 24 to the one before the last, which is the sign.
    "GLCC": FeedLayout("GLCC", Field("Id", 1, 18), Field("amount", 24, -1), Field("sign", -1, 1), 4),
}

EXPORT_FULL = [
    Field("txdate", 4, 5),
    Field("journal", 28, 9),
    Field("jrnl", 28, 11),
    Field("branch", 42, 5),
    Field("currency", 48, 3),
    Field("GLCC", 51, 18),
    Field("txnCode", 76, 6),
    Field("description", 82, 24),
    Field("txdatetwo", 111, 5),
    Field("lcyAmt", 116, 17),
    Field("fcyAmt", 133, 17),
    Field("acct", 160, 16),
    Field("sourceApp", 176, 3),
]
_SHORT_NAMES = {"txdate", "journal", "branch", "currency", "GLCC", "lcyAmt", "fcyAmt"}
EXPORT_SHORT = [f for f in EXPORT_FULL if f.name in _SHORT_NAMES]

# The mark in every file name, and the file families. The first kind
# comes as numbered files, the second as one file.
FAMILY_MARK = "GLIF"
NUMBERED_FAMILIES = [
    "INV", "PRI", "BOR", "PRB", "ONL", "AGRI_PY", "AGRI_CY", "INV_IN", "INV_TD", "INV_DC", "BOR_DC",
]
SINGLE_FAMILIES = [
    "INV_BC", "INV_FD", "INV_RE", "GEN_FIT", "INV_B8", "INV_CT", "INV_ECG", "INV_FCI", "BOR_VS", "INV_GB",
]


def family_patterns(folder: str) -> list[str]:
    """The globs of all file families in ``folder``."""
    folder = folder.rstrip("/")
    numbered = [f"{folder}/*{FAMILY_MARK}{name}_[0-9][0-9][0-9].gz" for name in NUMBERED_FAMILIES]
    single = [f"{folder}/*{FAMILY_MARK}{name}.gz" for name in SINGLE_FAMILIES]
    return numbered + single


def dated_path(base: str, day: str, sub: str, pattern: str) -> str:
    """``{base}/{yyyy-MM-dd}/{sub}/{pattern}``."""
    return "/".join([base.rstrip("/"), day, sub, pattern])
