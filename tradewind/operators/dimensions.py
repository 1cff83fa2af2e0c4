"""Small dimensions the warehouse is enriched with."""

from __future__ import annotations

# Ship city -> region code or name (74 cities, 58 regions).
CITY_REGION = {
    "Aachen": "NRW",
    "Albuquerque": "NM",
    "Anchorage": "AK",
    "Barcelona": "CT",
    "Barquisimeto": "Lara",
    "Bergamo": "Lombardy",
    "Berlin": "BE",
    "Bern": "BE",
    "Boise": "ID",
    "Boston": "MA",
    "Brandenburg": "BB",
    "Bruxelles": "Brussels",
    "Bräcke": "Jämtland",
    "Buenos Aires": "CABA",
    "Butte": "MT",
    "Campinas": "SP",
    "Caracas": "DF",
    "Charleroi": "Wallonia",
    "Colchester": "Essex",
    "Cork": "Co. Cork",
    "Cowes": "Isle of Wight",
    "Cunewalde": "Saxony",
    "Elgin": "OR",
    "Eugene": "OR",
    "Frankfurt": "HE",
    "Frankfurt a.M.": "HE",
    "Genève": "GE",
    "Graz": "Styria",
    "Helsinki": "Uusimaa",
    "I. de Margarita": "Nueva Esparta",
    "Kirkland": "WA",
    "Kobenhavn": "Hovedstaden",
    "Köln": "NRW",
    "Lander": "WY",
    "Leipzig": "Saxony",
    "Lille": "Hauts-de-France",
    "Lisboa": "Lisboa",
    "London": "LND",
    "Luleå": "Norrbotten",
    "Lyon": "Auvergne-Rhône-Alpes",
    "Madrid": "MD",
    "Mannheim": "BW",
    "Marseille": "Provence-Alpes-Côte d'Azur",
    "Montréal": "Québec",
    "México D.F.": "DF",
    "München": "BY",
    "Münster": "NW",
    "Nantes": "Pays de la Loire",
    "Oulu": "Northern Ostrobothnia",
    "Paris": "IDF",
    "Portland": "OR",
    "Reggio Emilia": "Emilia-Romagna",
    "Reims": "Grand Est",
    "Resende": "RJ",
    "Rio de Janeiro": "RJ",
    "Salzburg": "Salzburg",
    "San Cristóbal": "Táchira",
    "San Francisco": "CA",
    "Sao Paulo": "SP",
    "Seattle": "WA",
    "Sevilla": "Andalucía",
    "Stavern": "Vestfold og Telemark",
    "Stockholm": "Stockholm County",
    "Strasbourg": "Grand Est",
    "Stuttgart": "BW",
    "São Paulo": "SP",
    "Torino": "Piedmont",
    "Toulouse": "Occitanie",
    "Tsawassen": "BC",
    "Vancouver": "BC",
    "Versailles": "IDF",
    "Walla Walla": "WA",
    "Warszawa": "Mazowieckie",
    "Århus": "Midtjylland",
}

# Sales regions and the (corrected) customer countries in them.
REGION_COUNTRIES = {
    "Europe": (
        "Austria", "Belgium", "Denmark", "Finland", "France", "Germany", "Ireland", "Italy", "Norway",
        "Poland", "Portugal", "Spain", "Sweden", "Switzerland", "United Kingdom",
    ),
    "North America": ("Canada", "Mexico", "USA"),
    "South America": ("Argentina", "Brazil", "Venezuela"),
}

# Wrong -> right country, per dataset. The datasets disagree about "UK" on purpose.
CUSTOMER_COUNTRY_FIXES = {"Germani#": "Germany", "Poretugal#$": "Portugal", "UK": "United Kingdom"}
EMPLOYEE_COUNTRY_FIXES = {"UKA": "UK"}
VAT_COUNTRY_FIXES = {"Allemagne": "Germany"}

# Public ISO 3166 short names by continent code; "USA" and "Venezuela" are added because the data uses them.
# Territories and other spellings: pass a larger mapping to ``with_continent``.
CONTINENT_COUNTRIES = {
    "AF": (
        "Algeria", "Angola", "Benin", "Botswana", "Burkina Faso", "Burundi", "Cabo Verde", "Cameroon",
        "Central African Republic", "Chad", "Comoros", "Congo", "Congo, The Democratic Republic of the",
        "Côte d'Ivoire", "Djibouti", "Egypt", "Equatorial Guinea", "Eritrea", "Eswatini", "Ethiopia", "Gabon",
        "Gambia", "Ghana", "Guinea", "Guinea-Bissau", "Kenya", "Lesotho", "Liberia", "Libya", "Madagascar",
        "Malawi", "Mali", "Mauritania", "Mauritius", "Morocco", "Mozambique", "Namibia", "Niger", "Nigeria",
        "Rwanda", "Sao Tome and Principe", "Senegal", "Seychelles", "Sierra Leone", "Somalia", "South Africa",
        "South Sudan", "Sudan", "Tanzania, United Republic of", "Togo", "Tunisia", "Uganda", "Zambia", "Zimbabwe",
    ),
    "AS": (
        "Afghanistan", "Armenia", "Azerbaijan", "Bahrain", "Bangladesh", "Bhutan", "Brunei Darussalam",
        "Cambodia", "China", "Cyprus", "Georgia", "India", "Indonesia", "Iran, Islamic Republic of", "Iraq",
        "Israel", "Japan", "Jordan", "Kazakhstan", "Korea, Democratic People's Republic of",
        "Korea, Republic of", "Kuwait", "Kyrgyzstan", "Lao People's Democratic Republic", "Lebanon", "Malaysia",
        "Maldives", "Mongolia", "Myanmar", "Nepal", "Oman", "Pakistan", "Philippines", "Qatar", "Saudi Arabia",
        "Singapore", "Sri Lanka", "Syrian Arab Republic", "Taiwan, Province of China", "Tajikistan", "Thailand",
        "Turkey", "Turkmenistan", "United Arab Emirates", "Uzbekistan", "Viet Nam", "Yemen",
    ),
    "EU": (
        "Albania", "Andorra", "Austria", "Belarus", "Belgium", "Bosnia and Herzegovina", "Bulgaria", "Croatia",
        "Czechia", "Denmark", "Estonia", "Finland", "France", "Germany", "Greece", "Hungary", "Iceland",
        "Ireland", "Italy", "Latvia", "Liechtenstein", "Lithuania", "Luxembourg", "Malta",
        "Moldova, Republic of", "Monaco", "Montenegro", "Netherlands", "North Macedonia", "Norway", "Poland",
        "Portugal", "Romania", "Russian Federation", "San Marino", "Serbia", "Slovakia", "Slovenia", "Spain",
        "Sweden", "Switzerland", "Ukraine", "United Kingdom",
    ),
    "NA": (
        "Antigua and Barbuda", "Bahamas", "Barbados", "Belize", "Canada", "Costa Rica", "Cuba", "Dominica",
        "Dominican Republic", "El Salvador", "Grenada", "Guatemala", "Haiti", "Honduras", "Jamaica", "Mexico",
        "Nicaragua", "Panama", "Saint Kitts and Nevis", "Saint Lucia", "Saint Vincent and the Grenadines",
        "Trinidad and Tobago", "USA", "United States",
    ),
    "OC": (
        "Australia", "Fiji", "Kiribati", "Marshall Islands", "Micronesia, Federated States of", "Nauru",
        "New Zealand", "Palau", "Papua New Guinea", "Samoa", "Solomon Islands", "Tonga", "Tuvalu", "Vanuatu",
    ),
    "SA": (
        "Argentina", "Bolivia, Plurinational State of", "Brazil", "Chile", "Colombia", "Ecuador", "Guyana",
        "Paraguay", "Peru", "Suriname", "Uruguay", "Venezuela", "Venezuela, Bolivarian Republic of",
    ),
}


def _by_member(groups: dict[str, tuple[str, ...]]) -> dict[str, str]:
    return {member: group for group, members in groups.items() for member in members}


COUNTRY_REGION = _by_member(REGION_COUNTRIES)
COUNTRY_CONTINENT = _by_member(CONTINENT_COUNTRIES)
