"""Header fields: a table of labelled patterns applied to receipt text."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.functions.names import clean_company_name
from fiscalframe.functions.text import capture, strip
from fiscalframe.schema import PAYMENTS


@dataclass(frozen=True)
class FieldRule:
    """The first match wins; ``clean`` works on what the group captured.

    ``finder`` replaces the plain search where that would not be linear; it
    must capture what the pattern does.
    """

    pattern: str
    group: int = 1
    clean: Callable[[Column], Column] | None = None
    flags: str = "msdU"
    finder: Callable[[Column], Column] | None = None

    def find(self, text: Column) -> Column:
        """The capture; ``''`` both for no match and for an empty one."""
        if self.finder is not None:
            return self.finder(text)
        return capture(text, self.pattern, self.group, self.flags)

    def finish(self, captured: Column) -> Column:
        """Cleaned, with NULL for an empty result."""
        return F.nullif(captured if self.clean is None else self.clean(captured), F.lit(""))


def _company(captured: Column) -> Column:
    return clean_company_name(strip(captured))


# Printed labels (with their OCR spellings) and value shapes.
_REST = r"[:\s]*([^\n]*)"
_AMOUNT = r"(\d+\.\d{2})"
_SALE = r"Tarix[:\s]*(\d{2}\.\d{2}\.\d{4})\s*Vaxt[:\s]*(\d{2}:\d{2}:\d{2})"
_REFUND = r"Geri\s*qaytarılma\s*tarixi[:\s]*(\d{2}\.\d{2}\.\d{4})\s+(\d{2}:\d{2})"
_CODE = r"[:\s]*([\d\-]+)"
_TAXPAYER = r"Vergi\s*ödəyicisinin\s*adı" + _REST


def _store_code(text: Column) -> Column:
    """The code behind its label, or behind ``obyektin kodu`` anywhere after ``ÖV``, whichever starts first.

    Only the first ``ÖV`` can matter: where nothing is found behind it, nothing
    is behind a later one. So the text is cut there once, and each part is read once.
    """
    cut = F.instr(text, "ÖV")
    before = F.when(cut > 0, F.substr(text, F.lit(1), cut - 1)).otherwise(text)
    behind = F.when(cut > 0, F.substr(text, cut + 2))
    label, late = f"Obyektin\\s*kodu{_CODE}", f"obyektin\\s*kodu{_CODE}"
    found = [capture(before, label, flags="msdU"), capture(behind, late, flags="msdU"), capture(behind, label, flags="msdU")]
    return F.when(text.isNotNull(), F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit("")))


HEADER_RULES: dict[str, FieldRule] = {
    "taxpayer_name": FieldRule(_TAXPAYER, clean=_company),
    "store_address": FieldRule(r"(?:Obyektin\s*ünvanı|fani)" + _REST, clean=strip),
    "store_code": FieldRule(r"(?:Obyektin\s*kodu|ÖV.*?obyektin\s*kodu)" + _CODE, finder=_store_code),
    "tax_id": FieldRule(r"VÖEN[:\s]*(\d+)"),
    # The last three letters of the class are Cyrillic.
    "receipt_number": FieldRule(r"Satış\s*çeki\s*[№#NоМә]*\s*(\d+)"),
    "cashier_name": FieldRule(r"Kassir[:\s]*((?!Tarix)[^\n\d]*?)(?:\s+Tarix|\n|$)", clean=strip),
    "date": FieldRule(_SALE, 1),
    "time": FieldRule(_SALE, 2),
    "subtotal": FieldRule(r"Cəmi\s+" + _AMOUNT),
    "vat_18_percent": FieldRule(r"ƏDV\s*18%?\s*=\s*" + _AMOUNT),
    "total_tax": FieldRule(r"Toplam\s*vergi\s*=\s*" + _AMOUNT),
    "cashless_payment": FieldRule(r"Nağdsız[:\s]*" + _AMOUNT),
    "cash_payment": FieldRule(r"Nağd[:\s]*" + _AMOUNT),
    "bonus_payment": FieldRule(r"Bonus[:\s]*" + _AMOUNT),
    "advance_payment": FieldRule(r"Avans\s*\([^)]*\)[:\s]*" + _AMOUNT),
    "credit_payment": FieldRule(r"Nisyə[:\s]*" + _AMOUNT),
    "queue_number": FieldRule(r"Növbə\s*ərzində\s*vurulmuş\s*çek\s*sayı[:\s]*(\d+)"),
    "cash_register_model": FieldRule(r"NKA-nın\s*modeli" + _REST, clean=strip),
    "cash_register_serial": FieldRule(r"NKA-nın\s*zavod\s*nömrəsi" + _REST, clean=strip),
    "fiscal_id": FieldRule(r"Fiskal\s*[İI]D[:\s]*(\S+)"),
    "fiscal_registration": FieldRule(r"NMQ-nin\s*qeydiyyat\s*nömrəsi" + _REST, clean=strip),
    "refund_amount": FieldRule(r"Geri\s*qaytarılan\s*məbləğ[:\s]*" + _AMOUNT),
    "refund_date": FieldRule(_REFUND, 1),
    "refund_time": FieldRule(_REFUND, 2),
}
# Second chance for the fiscal number, any letter case.
FISCAL_ID_ANY_CASE = FieldRule(r"Fiskal\s*[İI]D[:\s]*(\w+)", flags="iudU")


def extract_fields(df: DataFrame, text: str, rules: Mapping[str, FieldRule]) -> DataFrame:
    """Add one column per rule, read from the ``text`` column; NULL where nothing was found."""
    # Two steps, so that no pattern is run twice for its null test and the
    # first one compiles into a method small enough for the JIT.
    # Rules that read different groups of one pattern share one pass over the
    # text: its whole match is kept, and the groups are read from that.
    shared = {(r.pattern, r.flags) for r in rules.values() if r.finder is None}
    shared = [k for k in sorted(shared) if sum((r.pattern, r.flags) == k and r.finder is None for r in rules.values()) > 1]
    match = {k: f"_match_{i}" for i, k in enumerate(shared)}
    whole = df.withColumns({name: capture(F.col(text), pattern, 0, flags) for (pattern, flags), name in match.items()})

    def source(rule: FieldRule) -> Column:
        key = (rule.pattern, rule.flags)
        return F.col(match[key]) if rule.finder is None and key in match else F.col(text)

    found = whole.withColumns({name: rule.find(source(rule)) for name, rule in rules.items()}).drop(*match.values())
    return found.withColumns({name: rule.finish(F.col(name)) for name, rule in rules.items()})


def payment_or_zero(amount: Column) -> Column:
    """A missing payment is ``0.00``; a captured one already has two decimals."""
    return F.coalesce(amount.try_cast("decimal(38,2)").cast("string"), F.lit("0.00"))


def _second_chance(text: Column) -> Column:
    return FISCAL_ID_ANY_CASE.finish(FISCAL_ID_ANY_CASE.find(text))


def extract_header(df: DataFrame, text: str = "text") -> DataFrame:
    """All header columns of the 30-column layout, with their fallbacks.

    Rows without text keep every header column null, payments included.
    """
    readable = F.col(text).isNotNull()
    out = extract_fields(df, text, HEADER_RULES)
    return out.withColumns(
        {
            "store_name": F.col("taxpayer_name"),
            "fiscal_id": F.coalesce("fiscal_id", _second_chance(F.col(text))),
            **{p: F.when(readable, payment_or_zero(F.col(p))) for p in PAYMENTS},
        }
    )
