"""Event vocabulary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions._cols import col
from footfall.schemas import (
    ALL,
    EVENT_ADD_TO_CART,
    EVENT_BROWSE_PRODUCT,
    EVENT_LAUNCH,
    EVENT_PAGE_VIEW,
    VIEW_EVENTS,
)

# Description and category of each event in the event dimension.
EVENT_TEXTS = {
    EVENT_LAUNCH: ("全站新用户访问", "全站产品体验行为"),
    EVENT_PAGE_VIEW: ("web浏览页面", "全站产品体验行为"),
    EVENT_BROWSE_PRODUCT: ("浏览商品详情页", "全站购买行为"),
    EVENT_ADD_TO_CART: ("加入购物车", "全站购买行为"),
    ALL: ("所有事件", "所有行为"),
}


def _lookup(event: Column, place: int) -> Column:
    out = F.lit(None).cast("string")
    for name, texts in EVENT_TEXTS.items():
        out = F.when(event == name, texts[place]).otherwise(out)
    return out


def event_description(event: Column | str) -> Column:
    """What the event means; null for one outside the vocabulary."""
    return _lookup(col(event), 0)


def event_category(event: Column | str) -> Column:
    """The group of behaviour the event belongs to; null for one outside the vocabulary."""
    return _lookup(col(event), 1)


def is_launch(event: Column | str) -> Column:
    return col(event) == EVENT_LAUNCH


def is_view(event: Column | str) -> Column:
    """A page view or a product view: the events that count as a step."""
    return col(event).isin(*VIEW_EVENTS)
