"""Where each field sits on each site's pages, as data.

Class names, ids and labels are fixed values: the sites' own markup vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from dwellframe.functions.select import El


@dataclass(frozen=True)
class Texts:
    """Direct texts of the elements at a path."""

    path: tuple[El, ...]


@dataclass(frozen=True)
class Attr:
    """An attribute of the elements at a path."""

    path: tuple[El, ...]
    name: str


@dataclass(frozen=True)
class AfterLabel:
    """Texts of the value element following a labelled element."""

    label: str
    label_tag: str
    value_tag: str


@dataclass(frozen=True)
class LabelledItem:
    """Texts of the list items mentioning a label."""

    label: str
    list_class: str = "list-info clearfix"


@dataclass(frozen=True)
class RunValue:
    """A column that came with the page."""

    column: str


Source = Texts | Attr | AfterLabel | LabelledItem | RunValue


@dataclass(frozen=True)
class Take:
    """How a list of texts becomes one value.

    ``at`` picks one text, from 0, negative from the end, if there are ``more_than`` or ``exactly``
    so many. Otherwise the first ``first`` texts (all, if none given) are joined with ``sep``, each
    trimmed, or only the whole with ``trim_whole``; ``when_empty`` says what no text gives. ``as_list``
    keeps the list.
    """

    at: int | None = None
    more_than: int = 0
    exactly: int | None = None
    sep: str = ""
    first: int | None = None
    trim_whole: bool = False
    prefix: str = ""
    when_empty: str | None = None
    as_list: bool = False


FIRST = Take(at=0)
LIST = Take(as_list=True)


@dataclass(frozen=True)
class SiteRules:
    page_style: str
    blocks: tuple[El, ...]
    hit_fields: dict[str, tuple[Source, Take]]
    page_fields: dict[str, tuple[Source, Take]]
    # what makes a page's record unusable: missing part -> condition over the page fields
    page_faults: dict[str, str] = field(default_factory=dict)
    # types whose search prices and sizes are read as numbers; None reads all
    parsed_types: tuple[str, ...] | None = None


def _css(*steps: El | str) -> tuple[El, ...]:
    return tuple(El(cls=s) if isinstance(s, str) else s for s in steps)


def _texts(*steps: El | str) -> Texts:
    return Texts(_css(*steps))


def _attr(name: str, *steps: El | str) -> Attr:
    return Attr(_css(*steps), name)


def _div(label: str) -> AfterLabel:
    return AfterLabel(label, "div", "div")


def _row(label: str) -> AfterLabel:
    return AfterLabel(label, "th", "span")


def _span(label: str) -> AfterLabel:
    return AfterLabel(label, "span", "span")


def _box(name: str) -> El:
    return El("span", id=f"MainContent_ctlDetailBox_{name}")


SECOND_OF_THREE = Take(at=1, more_than=2)
_GIA = _texts("kqchitiet", "gia-title", El("strong"))
_DATES = _texts("prd-more-info", El("div"))
_HIT_INFO = _texts("content", "info", El("span"))

BDS = SiteRules(
    page_style="path",
    blocks=(El("div", class_prefix="vip"),),
    hit_fields={
        "href": (_attr("href", "p-title", El("a")), FIRST),
        "property_price_raw": (_texts("product-price"), FIRST),
        "property_size_raw": (_texts("product-area"), FIRST),
        "property_area": (_texts("product-city-dist"), Take(sep=", ", when_empty="")),
        "posted_date": (_texts("floatright"), FIRST),
    },
    parsed_types=("sell", "rent"),
    page_fields={
        "posted_date": (_DATES, Take(at=-3, more_than=2)),
        "expire_date": (_DATES, Take(at=-1)),
        "title": (_texts("pm-title", El("h1")), FIRST),
        "description": (_texts("pm-content", "pm-desc"), Take(sep=" ", when_empty="")),
        "price_raw": (_GIA, FIRST),
        "property_size_raw": (_GIA, Take(at=1)),
        "area": (_attr("href", El("span", class_attr="diadiem-title mar-right-15"), El("a")), FIRST),
        "address": (_div("Địa chỉ"), FIRST),
        "num_floors_raw": (_div("Số tầng"), FIRST),
        "num_bedrooms_raw": (_div("Số phòng ngủ"), FIRST),
        "num_bathrooms_raw": (_div("Số toilet"), FIRST),
        "furniture": (_div("Nội thất\r\n"), FIRST),
        "frontage_raw": (_div("Mặt tiền"), FIRST),
        "house_orientation": (_div("Hướng nhà"), FIRST),
        "balcony_orientation": (_div("Hướng ban công"), FIRST),
        "distance_to_road_raw": (_div("Đường vào"), FIRST),
        "images": (_attr("src", El("div", class_attr="list-img"), El("img")), LIST),
        "videos": (_attr("src", El("div", id="LeftMainContent__productDetail_ltVideo"), El("iframe")), LIST),
        "listing_type": (_div("Loại tin rao"), FIRST),
        "contact_name": (_div("Tên liên lạc"), FIRST),
        "contact_phone": (_div("Điện thoại"), FIRST),
        "contact_mobile": (_div("Mobile"), FIRST),
        "contact_address": (_div("Địa chỉ"), Take(at=1, exactly=2)),
        "project_name": (_div("Tên dự án"), FIRST),
        "project_owner": (_div("Chủ đầu tư"), FIRST),
        "project_scale": (_div("Quy mô"), FIRST),
        "project_link": (_attr("href", El("a", id="LeftMainContent__productDetail_linkProject")), FIRST),
    },
    page_faults={
        "posted_date": "expire_date is not null and posted_date is null",
        "title": "title is null",
        "price": "price_raw is null",
        "property_size": "property_size_raw is null",
    },
)

MBND = SiteRules(
    page_style="query",
    blocks=_css("resultItem"),
    hit_fields={
        "href": (_attr("href", "row title", El("a")), FIRST),
        "property_price_raw": (_texts("listing-price"), FIRST),
        "property_size_raw": (_texts("col-xs-12 lline"), Take(at=-1)),
        "property_area": (_texts("row lline", "col-xs-6"), Take(sep=", ", when_empty="")),
        "posted_date": (_texts("col-lg-4 lline hidden-xs"), FIRST),
    },
    page_fields={
        "posted_date": (_texts(_box("lblDateCreated")), FIRST),
        "title": (_texts("navi-title"), FIRST),
        "description": (_texts("box-description"), Take(sep=" ")),
        "price_raw": (_texts(_box("lblPrice")), FIRST),
        "property_size_raw": (_row("Diện tích"), FIRST),
        "ward": (_texts(_box("lblWard"), El("a")), FIRST),
        "district": (_texts(_box("lblDistrict"), El("a")), FIRST),
        "city": (_texts(_box("lblCity"), El("a")), FIRST),
        "address": (_texts(_box("lblStreet")), FIRST),
        "ownership_certificate": (_row("Tình trạng pháp lý"), FIRST),
        "road_width": (_row("Đường trước nhà"), FIRST),
        "num_floors_raw": (_row("Số tầng"), FIRST),
        "num_bedrooms_raw": (_row("Phòng ngủ"), FIRST),
        "num_bathrooms_raw": (_row("Phòng tắm"), FIRST),
        "furniture": (_row("Tiện ích"), Take(sep=",", trim_whole=True, prefix=" ", when_empty=" ")),
        "house_orientation": (_row("Hướng"), FIRST),
        "images": (_attr("src", El("div", class_attr="flexslider"), El("img")), LIST),
        "listing_type": (RunValue("type"), FIRST),
        "contact_name": (_texts("name-contact", El("a")), FIRST),
        "contact_address": (_texts(_box("lblAddressContact")), FIRST),
        "contact_href": (_attr("href", "name-contact", El("a")), FIRST),
        "project_name": (_texts(_box("lblProject"), El("a")), FIRST),
        "project_link": (_attr("href", _box("lblProject"), El("a")), FIRST),
    },
)

TBDS = SiteRules(
    page_style="path",
    blocks=_css("col-gr-75per", "group-prd", El("li")),
    hit_fields={
        "href": (_attr("href", "content", "title", El("a")), FIRST),
        "property_price_raw": (_HIT_INFO, FIRST),
        "property_size_raw": (_HIT_INFO, Take(at=1)),
        "property_area": (_texts("content", "fsize-13"), Take(at=1)),
    },
    page_fields={
        "posted_date": (_texts("list-info clearfix", "value line"), Take(sep="/", first=2, more_than=2)),
        "title": (_texts("folder-title", El("h1")), FIRST),
        "description": (_texts(El("div", id="infoDetail")), Take(sep=" ")),
        "price_raw": (_span("Giá"), FIRST),
        "property_size_raw": (_span("Diện tích"), FIRST),
        "address": (_texts("folder-title", "pull-left"), Take(at=2)),
        "num_bedrooms_raw": (LabelledItem("Số phòng"), SECOND_OF_THREE),
        "num_bathrooms_raw": (LabelledItem("Số toilet"), SECOND_OF_THREE),
        "num_floors_raw": (LabelledItem("Số tầng"), SECOND_OF_THREE),
        "distance_to_road_raw": (LabelledItem("Đường vào"), SECOND_OF_THREE),
        "frontage_raw": (LabelledItem("Mặt tiền"), SECOND_OF_THREE),
        "house_orientation": (LabelledItem("Hướng nhà"), SECOND_OF_THREE),
        "images": (_attr("src", "slide_show", El("img")), LIST),
        "listing_type": (RunValue("type"), FIRST),
        "contact_name": (_texts("info-contact", "fweight-bold dblue-clr"), FIRST),
        "contact_phone": (_texts("info-contact", El("span", id="toPhone")), FIRST),
        "contact_email": (_texts("info-contact", El("span", id="toEmail")), FIRST),
        "contact_address": (_texts("info-contact", El("span", id="toAddress")), FIRST),
    },
)

SITES: dict[str, SiteRules] = {"bds": BDS, "mbnd": MBND, "tbds": TBDS}
