"""What differs between shops, as data."""

from __future__ import annotations

from dataclasses import dataclass, field

# Patterns of the attributes one shop writes into its listing HTML,
# with the group to keep.
HTML_ATTRIBUTES: dict[str, tuple[str, int]] = {
    "condition": (r"<b>Condition:</b>\s*([A-Za-z ]+).", 1),
    "condition_details": (r"<b>Condition:</b> [A-Za-z ]+\. ([^<]+).<br>", 1),
    "accessories": (r"<b>Accessories:</b> (.+?) <br>", 1),
    "height_inches": (r"Height (\d+)", 1),
    "width_inches": (r"Width (\d+)", 1),
    "depth_inches": (r"Depth (\d+)", 1),
    "exterior_material": (r"<b>Exterior Material:</b> (.+?) <br>", 1),
    "exterior_color": (r"<b>Exterior Color:</b> (.+?) <br>", 1),
    "interior_material": (r"<b>Interior Material:</b> (.+?) <br>", 1),
    "interior_color": (r"<b>Interior Color:</b> (.+?) <br>", 1),
    "hardware_color": (r"<b>Hardware Color:</b> (.+?) <br>", 1),
}


@dataclass(frozen=True)
class StoreSpec:
    """One shop: its name, URL base, first day and HTML attributes (if it has any)."""

    name: str
    url_base: str
    start_date: str = "2024-11-13"
    attributes: dict[str, tuple[str, int]] = field(default_factory=dict)
    has_type_chart: bool = True


# Shop names, URL bases and first days.
STORES: tuple[StoreSpec, ...] = (
    StoreSpec("vsp", "https://vspconsignment.com/en-us/products/", "2024-11-13", has_type_chart=False),
    StoreSpec("rebag", "https://shop.rebag.com/products/", "2024-11-13", HTML_ATTRIBUTES),
    StoreSpec("dct", "https://dct-ep-vintageluxurystore.com/products/", "2024-12-08"),
    StoreSpec(
        "treasures",
        "https://treasuresofnewyorkcity.com/collections/handbags-1/products/",
        "2024-12-08",
    ),
)
