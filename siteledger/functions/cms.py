"""Site-builder detection from raw HTML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literal markers and the product each one stands for, in the
# order in which they are tried.
CMS_MARKERS = [
    ('src="/bitrix/', "Bitrix"),
    ('<link href="/bitrix', "Bitrix"),
    ("/wp-content/themes/", "Wordpress"),
    ('<meta name="modxru', "ModX"),
    ('<script type="text/javascript" src="/netcat', "Netcat"),
    ('<script src="/phpshop', "PhpShop"),
    ('<script type="text/x-magento-init', "Magento"),
    ("/wa-data/public", "Shop-Script"),
    ("catalog/view/theme", "OpenCart"),
    ("data-drupal-", "Drupal"),
    ('<meta name="generator" content="Joomla', "Joomla"),
    ("var dle_admin", "DataLife Engine"),
    ("UCOZ-JS", "Ucoz"),
    ('<script src="https://static.tilda', "Tilda"),
    ('<meta name="generator" content="Wix', "Wix"),
    ('href="https://nethouse.ru/?p', "Nethouse"),
    ("data-muse-uid", "Adobe Muse"),
    ('img src="/images/cms/', "UMI"),
    ("-= Amiro.CMS (c) =-", "Amiro"),
    ('content="CMS EDGESTILE SiteEdit">', "SiteEdit"),
    ('meta name="generator" content="OkayCMS', "Okay"),
]


def cms(html: Column, markers=CMS_MARKERS) -> Column:
    """Product of the first marker contained in the HTML; "" when none is."""
    (first, product), *rest = markers
    found = F.when(F.contains(html, F.lit(first)), F.lit(product))
    for marker, product in rest:
        found = found.when(F.contains(html, F.lit(marker)), F.lit(product))
    return found.otherwise(F.lit(""))
