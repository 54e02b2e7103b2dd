"""Golden data: the published weekly site funnel (the weeks around the three
changes, plus one week outside each window) and the published funnel impact
result.  Numbers copied from the published outputs."""

# week, sessions, product_views, add_to_cart, begin_checkout, add_shipping_info, add_payment_info, purchase
WEEKLY_FUNNEL = [
    ("2025-03-03", 96282, 118759, 3685, 979, 7090, 515, 347),
    ("2025-03-10", 94531, 128501, 3749, 1107, 715, 555, 375),
    ("2025-03-17", 120437, 175094, 5297, 1578, 1025, 844, 538),
    ("2025-03-24", 135732, 196016, 5980, 2027, 1285, 1119, 654),
    ("2025-03-31", 139646, 181910, 5049, 1844, 1189, 1089, 667),
    ("2025-04-07", 137964, 178205, 5166, 1710, 1185, 1011, 572),
    ("2025-04-14", 141242, 194251, 5359, 1750, 1107, 1037, 559),
    ("2025-04-21", 149284, 203083, 5918, 2067, 1335, 1190, 638),
    ("2025-04-28", 135287, 172157, 4858, 1714, 1090, 1045, 552),
    ("2025-05-05", 139676, 184922, 5467, 1833, 1191, 1025, 623),
    ("2025-06-30", 131325, 150698, 4826, 1149, 892, 771, 512),
    ("2025-07-07", 140113, 149145, 5090, 1482, 868, 726, 494),
    ("2025-07-14", 135962, 164348, 5160, 1474, 873, 769, 489),
    ("2025-07-21", 136909, 171934, 5198, 1632, 872, 780, 521),
    ("2025-07-28", 148551, 190503, 5862, 1799, 1018, 885, 597),
    ("2025-08-04", 143327, 183678, 5546, 1777, 963, 922, 579),
    ("2025-08-11", 140290, 178266, 6085, 1819, 1006, 896, 535),
    ("2025-08-18", 138245, 186268, 7202, 2207, 1213, 1061, 613),
    ("2025-08-25", 115096, 138402, 4841, 1544, 859, 807, 453),
    ("2025-09-01", 108361, 126187, 3963, 1127, 638, 509, 369),
    ("2026-02-23", 191726, 209776, 6652, 2192, 1274, 1306, 379),
    ("2026-03-02", 112940, 117844, 3273, 748, 425, 391, 131),
    ("2026-03-09", 109260, 116113, 3708, 1625, 1284, 1244, 136),
    ("2026-03-16", 107712, 115438, 3149, 798, 476, 454, 262),
    ("2026-03-23", 142550, 163983, 5118, 1318, 779, 792, 509),
    ("2026-03-30", 161432, 196600, 5526, 1333, 746, 721, 513),
    ("2026-04-06", 145454, 178347, 5138, 1273, 794, 818, 495),
    ("2026-04-13", 140681, 176682, 5368, 1500, 886, 895, 500),
    ("2026-04-20", 130245, 156176, 5458, 1664, 992, 1163, 535),
    ("2026-04-27", 139818, 169929, 5127, 1600, 945, 1032, 496),
]

# change_label, period, 7 averages (1 dp), 7 step rates (2 dp)
FUNNEL_IMPACT = [
    ("Apr 2025: Medium & Large increase", "before", 122586.5, 170380.3, 5018.8, 1639.0, 1053.5, 901.8, 558.5,
     2.95, 32.66, 64.28, 85.6, 61.94, 34.08, 11.13),
    ("Apr 2025: Medium & Large increase", "after", 140944.3, 186924.0, 5325.3, 1810.3, 1179.3, 1070.8, 580.3,
     2.85, 33.99, 65.14, 90.8, 54.19, 32.05, 10.9),
    ("Aug 2025: Small furniture increase", "before", 140383.8, 168982.5, 5327.5, 1596.8, 907.8, 790.0, 525.3,
     3.15, 29.97, 56.85, 87.03, 66.49, 32.89, 9.86),
    ("Aug 2025: Small furniture increase", "after", 134239.5, 171653.5, 5918.5, 1836.8, 1010.3, 921.5, 545.0,
     3.45, 31.03, 55.0, 91.22, 59.14, 29.67, 9.21),
    ("Mar 2026: Medium & Large increase", "before", 118115.5, 128344.5, 3812.0, 1122.3, 741.0, 720.3, 259.5,
     2.97, 29.44, 66.03, 97.2, 36.03, 23.12, 6.81),
    ("Mar 2026: Medium & Large increase", "after", 144453.0, 176951.3, 5372.5, 1442.5, 854.5, 899.3, 510.8,
     3.04, 26.85, 59.24, 105.24, 56.8, 35.41, 9.51),
]
