"""Hand-written listing pages of a few days."""

import json
import os

BODY = (
    "<b>Condition:</b> Excellent. Light wear to corners.<br><b>Accessories:</b> Dust Bag <br>"
    "<b>Measurements:</b> Height 9, Width 12, Depth 4 <br><b>Exterior Color:</b> Brown <br>"
)


def product(id, updated="2024-12-08T10:00:00-05:00", price="100.00", **other):
    row = {
        "id": id,
        "title": f"Bag {id}",
        "handle": f"bag-{id}",
        "body_html": BODY,
        "vendor": "Chanel",
        "product_type": "Handbag",
        "published_at": "2024-11-20T23:30:00-05:00",
        "updated_at": updated,
        "variants": [{"price": price, "sku": "x"}],
    }
    row.update(other)
    return row


def write_page(root, store, day, name, products, indent=None):
    year, month, dom = (int(x) for x in day.split("-"))
    folder = os.path.join(root, store, str(year), str(month), str(dom))
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump({"products": products}, f, indent=indent, ensure_ascii=False)
    open(os.path.join(folder, "trigger.txt"), "w").close()
    return folder
