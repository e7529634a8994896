"""Published weekly index of one national series, and published features of 14 series
with their clusters. Results must equal what is published for them."""

START = "2024-07-07"
TOTAL = [
    111.8, 112.8, 116.1, 115.3, 116.4, 119.4, 117.2, 115.2, 117.5, 115.4, 114.1, 112.4, 106.9, 109.0,
    106.9, 105.3, 103.6, 105.1, 106.7, 108.5, 113.7, 117.3, 127.7, 133.5, 136.7, 132.8, 92.5, 90.7,
    90.2, 93.6, 98.8, 98.7, 101.5, 103.7, 101.2, 102.8, 103.7, 105.0, 105.0, 101.5, 103.9, 104.5,
    101.7, 102.0, 101.8, 104.7, 102.8, 105.7, 104.3, 107.5, 108.9, 109.8, 111.1, 115.1, 116.3, 115.6,
    116.7, 119.1, 116.5, 116.5, 113.8, 112.9, 113.7, 108.5, 107.9, 107.6, 105.7, 103.6, 103.3, 105.4,
    104.7, 107.1, 111.1, 120.5, 125.9, 134.3, 135.0, 131.7, 91.2, 89.0, 92.3, 94.7, 99.0, 99.7, 103.1,
    100.9, 102.9, 103.6, 101.9, 101.5,
]

# mean, std, slope, amplitude, december, january, recovery, current, year-on-year, cluster id
FEATURES = {
    "UK Total": (108.92, 10.26, -0.0677, 47.7, 130.54, 91.78, 0.262, 101.5, -3.5, 2),
    "England": (110.02, 10.51, -0.0573, 47.8, 131.9, 92.09, 0.264, 102.1, -0.5, 2),
    "Northern Ireland": (110.24, 17.45, -0.0996, 79.4, 146.97, 80.46, 0.331, 101.7, 1.3, 0),
    "Scotland": (111.01, 15.22, -0.095, 68.7, 142.3, 84.45, 0.325, 102.5, 1.0, 0),
    "Wales": (108.27, 12.25, -0.0685, 54.6, 133.72, 86.95, 0.313, 102.2, -0.7, 2),
    "East of England": (111.94, 10.34, -0.0572, 46.9, 133.69, 94.16, 0.311, 105.9, -1.5, 1),
    "East Midlands": (108.41, 11.29, -0.0709, 50.8, 131.86, 89.26, 0.287, 100.5, -2.9, 2),
    "London": (116.08, 10.25, -0.0609, 46.2, 137.28, 98.11, 0.275, 108.5, -1.4, 1),
    "North East": (106.09, 12.49, -0.0767, 55.6, 131.94, 84.28, 0.322, 99.7, 1.0, 2),
    "North West": (109.83, 11.22, -0.0648, 52.3, 133.01, 90.32, 0.306, 102.7, 0.6, 2),
    "South East": (111.93, 10.46, -0.0514, 49.5, 133.64, 94.02, 0.283, 104.8, 0.6, 1),
    "South West": (110.5, 11.21, -0.0754, 49.5, 133.81, 91.76, 0.287, 104.0, -1.5, 2),
    "West Midlands": (108.41, 11.27, -0.0624, 51.0, 132.33, 89.52, 0.278, 100.3, -3.0, 2),
    "Yorkshire & Humber": (107.25, 12.44, -0.0714, 57.3, 132.71, 85.5, 0.316, 100.3, -1.7, 2),
}
SEEDS = {
    3: ["North West", "South West", "UK Total"],
    2: ["North West", "South West"],
    4: ["North West", "South West", "UK Total", "Yorkshire & Humber"],
}
NAMES = {0: "Stable Mid-Tier", 1: "High-Performance Metros", 2: "Recovering Regions"}
PCA = {
    "UK Total": (1.6095, 1.1563),
    "England": (1.9043, 0.6189),
    "Northern Ireland": (-5.5925, -1.7556),
    "Scotland": (-3.5472, -1.4922),
}
FORECAST = [
    (100.86, 117.71, 84.01), (99.98, 118.25, 81.7), (100.15, 119.85, 80.46), (100.01, 121.12, 78.89),
    (99.25, 121.79, 76.71), (99.05, 123.01, 75.08), (98.76, 124.15, 73.37), (99.02, 125.83, 72.22),
]
