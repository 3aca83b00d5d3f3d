"""Order status columns: stage, cancel reason, payment wording, final state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from ledgerloom.functions import fixed_values as fv
from ledgerloom.functions.rules import multi_col_rules, pattern_map, value_map


def is_cancel(status: Column) -> Column:
    return status.like(fv.CANCEL_PATTERN)


def progress_label(status: Column) -> Column:
    """Stage label of a status, cancels left NULL."""
    return value_map(
        status,
        {
            fv.SUBMITTED: fv.SUBMITTED_STATUSES,
            fv.ACCEPTED: fv.ACCEPTED_STATUSES,
            fv.COMPLETED: fv.COMPLETED_STATUSES,
            fv.RETURNED: fv.RETURNED_STATUSES,
        },
    )


def stage_of(status: Column, paid: Column, pay_types: Column) -> Column:
    """Stage label; unpaid new orders and unpaid cash-on-delivery approvals are only created."""
    unpaid = paid.eqNullSafe(F.lit(False))
    created = unpaid & (
        (status == "new") | ((status == "pending_approve") & (pay_types == "COD"))
    )
    return (
        F.when(created, fv.CREATED)
        .when(is_cancel(status), fv.CANCELLED)
        .otherwise(progress_label(status))
    )


def stage_number(stage: Column) -> Column:
    return value_map(stage, {n: (label,) for label, n in fv.STAGE_NUMBERS.items()})


def cancel_reason(stage: Column, status: Column, reason: Column, bank_status: Column) -> Column:
    """Reason of a cancel: reason code or bank answer first, then the status itself."""
    sources = {"cancelled_reason": reason, "bank_status": bank_status}
    by_code = multi_col_rules([(sources[c] == value, label) for c, value, label in fv.REASON_RULES])
    return F.coalesce(
        F.when(stage == fv.CANCELLED, by_code), pattern_map(status, fv.STATUS_REASONS)
    )


def delivery_label(status: Column, delivery_types: Column) -> Column:
    return multi_col_rules(
        [
            ((status == "delivered") & (delivery_types == "delivery"), fv.DELIVERY_COURIER),
            ((status == "delivered") & (delivery_types == "kazpost"), fv.DELIVERY_POST),
            (status == "taken", fv.DELIVERY_PICKUP),
        ]
    )


@dataclass(frozen=True)
class Lender:
    """Names of the express-loan product: its code prefix and its wording."""

    code: str = "EXPRESS"
    title: str = "Экспресс кредит"

    @property
    def pattern(self) -> str:
        return f"%{self.code}%"

    def named(self, table: Mapping[str, Sequence[str]]) -> dict[str, tuple[str, ...]]:
        """A fixed table with this lender's code and wording filled in."""
        return {
            label: tuple(text.format(code=self.code, title=self.title) for text in texts)
            for label, texts in table.items()
        }

    def pay_group(self, pay_types: Column, pay_title: Column) -> Column:
        """Payment wording that orders are grouped by."""
        return multi_col_rules(
            [
                (pay_types == "ACQUIRING", fv.CREDIT_CARD),
                (pay_types.like(self.pattern), self.title),
            ],
            pay_title,
        )

    def payment_product(
        self, pay_types: Column, pay_code: Column, pay_title: Column, loan_product: Column
    ) -> Column:
        """Canonical payment product: tariff code, card wording, express code, loan
        product, remaining wordings, in this order; else the wording as it is.

        ``loan_product`` is already canonical (``LOAN_PRODUCTS``) or NULL."""
        known = self.named
        return F.coalesce(
            value_map(pay_code, fv.CARD_CODES),
            value_map(pay_title, fv.CARD_TITLES),
            value_map(pay_code, known(fv.EXPRESS_CODES)),
            loan_product,
            value_map(pay_title, known(fv.LOAN_TITLES)),
            F.when(pay_types.like(self.pattern), self.title),
            pay_title,
        )

    def rate_columns(self) -> dict[str, str]:
        """Payment product to the tariff column that holds its rate."""
        tables = (self.named(fv.EXPRESS_CODES), fv.CARD_CODES, fv.CARD_RATE)
        return {product: codes[0] for table in tables for product, codes in table.items()}

    def rate_codes(self) -> list[str]:
        """All tariff columns, in their stored order."""
        return [text.format(code=self.code) for text in fv.RATE_CODES]


def progress_description(
    s2: Column, s3: Column, s4: Column, label3: Column, reason: Column, pay: Column, lender: Lender
) -> Column:
    """Where an order that was taken up stands now."""
    waiting = F.when(pay == lender.title, fv.APPROVED).when(pay != lender.title, fv.AT_MERCHANT)
    return multi_col_rules(
        [
            (is_cancel(s3) & (label3 != fv.ACCEPTED), reason),
            (s3.isin(*fv.POST_STATUSES) & (s4 == "delivered"), fv.POST_WITH_COURIER),
            (s3 == "courier_delivery", fv.POST_WITH_COURIER),
            (s3 == "awaiting_parcel_ready", fv.POST_WAITS_PARCEL),
            (s3.isin("awaiting_courier_pickup", "sync_with_delivery"), fv.POST_WAITS_COURIER),
            ((s2 == "pending_pickup") | s3.isin("pending_pickup", "taken"), fv.AT_PICKUP),
            ((s2 == "on_delivery") | s3.isin("on_delivery", "delivered"), fv.ON_DELIVERY),
            (s2 == "awaiting_loan_approve", fv.AT_SIGNING),
            (s2 == "approved_not_filled", fv.WAITS_FORM),
            (s2 == "filled_not_approved", fv.AT_MERCHANT),
            (s2 == "pending_approve", waiting),
        ]
    )


def terminal_description(s3: Column, s4: Column, label3: Column, reason: Column) -> Column:
    """How the order ended: cancel reason, handed over, delivered."""
    return multi_col_rules(
        [
            (is_cancel(s3) & (label3 == fv.ACCEPTED), reason),
            (is_cancel(s4), reason),
            *[((s4 == status) | (s3 == status), text) for text, status in fv.ENDINGS],
        ]
    )


def return_description(s4: Column, s5: Column) -> Column:
    return F.when((s4 == "returned") | (s5 == "returned"), fv.GIVEN_BACK)
