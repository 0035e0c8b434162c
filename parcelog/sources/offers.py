"""Nested offer documents to flat rows, and the rules that keep values plausible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelog.functions.text import completion_text, counts_text, view_counts
from parcelog.functions.values import folded_address, price_history, rows_json

#: Schemas of documents (fixed values).
ADDRESS = "array<struct<type:string, name:string, shortName:string, fullName:string, id:long>>"
UNDERGROUNDS = "array<struct<name:string, travelTime:int, travelType:string>>"
RAILWAYS = "array<struct<name:string, time:int, travelType:string, distance:string>>"
HIGHWAYS = "array<struct<name:string, distance:string>>"
CHANGES = "array<struct<changeTime:string, priceData:struct<price:long>>>"
GEO = f"""struct<
  coordinates:struct<lat:double, lng:double>, address:{ADDRESS},
  undergrounds:{UNDERGROUNDS}, railways:{RAILWAYS}, highways:{HIGHWAYS}, jk:struct<id:long, name:string>>"""
TERMS = """struct<
  price:long, priceRur:long, priceType:string, currency:string, mortgageAllowed:boolean, saleType:string,
  deposit:decimal(18,2), agentFee:decimal(18,2), clientFee:decimal(18,2), prepayMonths:int, leaseTermType:string,
  paymentPeriod:string, utilitiesTerms:struct<includedInPrice:boolean, price:decimal(18,2)>>"""
BUILDING = """struct<
  floorsCount:int, buildYear:int, yearRelease:int, materialType:string, ceilingHeight:string, parking:struct<type:string>,
  passengerLiftsCount:int, cargoLiftsCount:int, deadline:struct<year:int, quarter:string>, isEmergency:boolean,
  hasPlayground:boolean, hasSportsground:boolean, houseMaterialType:string, houseHeatSupplyType:string,
  houseGasSupplyType:string, houseOverlapType:string, houseOverhaulFundType:string, flatCount:int, entrances:int,
  seriesName:string, chuteCount:int, demolishedInMoscowProgramm:boolean>"""
NEWBUILDING = """struct<
  id:long, name:string, isFromDeveloper:boolean, isFromBuilder:boolean, newbuildingFeatures:struct<deadlineInfo:string>,
  house:struct<id:long, finishDate:struct<year:int, quarter:string>>>"""
AGENT = "struct<accountType:string, userType:string, userTrustLevel:string, isAgent:boolean, isBuilder:boolean, agencyName:string>"
STATS = "struct<totalViewsFormattedString:string>"
_OFFER_FIELDS = f"""
  id:long, category:string, dealType:string, totalArea:string, livingArea:string, kitchenArea:string, allRoomsArea:string,
  isStudio:boolean, flatType:string, roomType:string, roomsCount:int, floorNumber:int, combinedWcsCount:int,
  separateWcsCount:int, balconiesCount:int, loggiasCount:int, windowsViewType:string, isApartments:boolean,
  isPenthouse:boolean, repairType:string, decoration:string, passengerLiftsCount:int, cargoLiftsCount:int,
  description:string, descriptionMinhash:string, creationDate:string, editDate:string, status:string, cianUserId:long,
  isByHomeowner:boolean, demolishedInMoscowProgramm:boolean, hasFurniture:boolean, hasRamp:boolean, fromDeveloper:boolean,
  bedsCount:int, petsAllowed:boolean, childrenAllowed:boolean, hasFridge:boolean, hasWasher:boolean, hasDishwasher:boolean,
  hasConditioner:boolean, hasTv:boolean, hasInternet:boolean, photos:array<struct<id:long>>,
  phones:array<struct<number:string>>, bargainTerms:{TERMS}, geo:{GEO}, building:{BUILDING}, newbuilding:{NEWBUILDING}"""
OFFER = f"struct<{_OFFER_FIELDS}>"
DOCUMENT = f"struct<offer:{OFFER}, agent:{AGENT}, stats:{STATS}, priceChanges:{CHANGES}>"
#: An offer of the search interface: what stands beside the offer in a page's document stands inside it.
API_OFFER = f"struct<{_OFFER_FIELDS}, user:{AGENT}, statistic:{STATS}, priceChanges:{CHANGES}>"

#: Columns that are a field of the document as it is (fixed values).
OFFER_FIELDS = {
    "rooms": "roomsCount", "flat_type": "flatType", "room_type": "roomType", "floor": "floorNumber", "window_view": "windowsViewType",
    "is_apartments": "isApartments", "is_penthouse": "isPenthouse", "description": "description", "descr_minhash": "descriptionMinhash",
    "publication_date": "creationDate", "edit_date": "editDate", "status": "status", "cian_user_id": "cianUserId",
    "seller_is_owner": "isByHomeowner", "demolished_in_renovation": "demolishedInMoscowProgramm", "has_furniture": "hasFurniture",
    "has_ramp": "hasRamp", "from_developer": "fromDeveloper", "beds_count": "bedsCount", "pets_allowed": "petsAllowed",
    "children_allowed": "childrenAllowed", "has_fridge": "hasFridge", "has_washer": "hasWasher", "has_dishwasher": "hasDishwasher",
    "has_conditioner": "hasConditioner", "has_tv": "hasTv", "has_internet": "hasInternet",
}
TERM_FIELDS = {
    "price_type": "priceType", "currency": "currency", "mortgage_allowed": "mortgageAllowed", "deal_conditions": "saleType",
    "deposit": "deposit", "agent_fee": "agentFee", "client_fee": "clientFee", "prepay_months": "prepayMonths",
    "lease_term_type": "leaseTermType", "payment_period": "paymentPeriod",
}
BUILDING_FIELDS = {
    "total_floors": "floorsCount", "year_built": "buildYear", "year_release": "yearRelease", "building_type": "materialType",
    "is_emergency": "isEmergency", "has_playground": "hasPlayground", "has_sportsground": "hasSportsground",
    "house_material_type": "houseMaterialType", "house_heat_supply_type": "houseHeatSupplyType",
    "house_gas_supply_type": "houseGasSupplyType", "house_overlap_type": "houseOverlapType",
    "house_overhaul_fund_type": "houseOverhaulFundType", "flat_count": "flatCount", "entrances": "entrances",
    "series_name": "seriesName", "chute_count": "chuteCount",
}
AGENT_FIELDS = {
    "seller_type": "accountType", "seller_user_type": "userType", "user_trust_level": "userTrustLevel", "is_agent": "isAgent",
    "is_builder": "isBuilder", "agency_name": "agencyName",
}
#: Least and greatest plausible values (fixed values).
RANGES = {
    "total_area": (5, 3000),
    "living_area": (2, 3000),
    "kitchen_area": (1, 500),
    "ceiling_height": (2, 10),
    "lat": (41, 82),
    "lon": (19, 191),
    "total_floors": (1, 130),
    "floor": (-5, 130),
    "rooms": (0, 30),
    "photos_count": (0, 500),
    "flat_count": (1, 30000),
    "entrances": (1, 300),
    "chute_count": (0, 300),
    "passenger_lifts": (0, 60),
    "cargo_lifts": (0, 60),
    "beds_count": (1, 100),
    "views_total": (0, 10_000_000),
    "views_today": (0, 1_000_000),
}
FIRST_YEAR, YEARS_AHEAD = 1700, 8


def deal_type(category: Column, deal: Column) -> Column:
    """Daily flats are rented by the day, other rents for long; all else is a sale."""
    return F.when(category == "dailyFlatRent", "rent_day").when(deal == "rent", "rent_long").otherwise("sale")


def _positive(x: Column) -> Column:
    return F.when(x != 0, x)


def number(text: Column) -> Column:
    """First number of a text, blanks inside it dropped, with point or comma."""
    found = F.regexp_extract(F.regexp_replace(text.cast("string"), r"[\s ]", ""), r"(-?[0-9]+(?:[.,][0-9]+)?)", 1)
    return F.replace(found, F.lit(","), F.lit(".")).try_cast("double")


def _filled(text: Column) -> Column:
    return F.when(text != "", text)


def _true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def offer_columns(o: Column, agent: Column, stats: Column, changes: Column, address: Column) -> dict[str, Column]:
    """All flat columns of an offer, its seller, its view counts and its price changes; ``address`` is the offer's, folded."""
    terms, building, geo, new = o["bargainTerms"], o["building"], o["geo"], o["newbuilding"]
    price = F.coalesce(_positive(terms["priceRur"]), _positive(terms["price"]))
    area = number(o["totalArea"])
    total, today = view_counts(stats["totalViewsFormattedString"])
    deadline, finish = building["deadline"], new["house"]["finishDate"]
    as_given = [(o, OFFER_FIELDS), (terms, TERM_FIELDS), (building, BUILDING_FIELDS), (agent, AGENT_FIELDS)]
    return {
        **{column: source[field] for source, fields in as_given for column, field in fields.items()},
        **{k: address[k] for k in ("region", "municipality", "district", "microdistrict", "street", "house", "house_id")},
        "deal_type": deal_type(o["category"], o["dealType"]),
        "price": price,
        "price_per_m2": (price / _positive(area)).cast("bigint"),
        "utilities_included": terms["utilitiesTerms"]["includedInPrice"],
        "utilities_price": terms["utilitiesTerms"]["price"],
        "lat": geo["coordinates"]["lat"],
        "lon": geo["coordinates"]["lng"],
        "metro_stations": rows_json(geo["undergrounds"], "name", "travelTime", "travelType", numbers=("travelTime",)),
        "railways": rows_json(geo["railways"], "name", "time", "travelType", "distance", numbers=("time",)),
        "highways": rows_json(geo["highways"], "name", "distance"),
        "is_studio": _true(o["isStudio"]) | _true(o["flatType"] == "studio"),
        "total_area": area,
        **{f"{k}_area": number(o[f]) for k, f in (("living", "livingArea"), ("kitchen", "kitchenArea"))},
        "all_rooms_area": o["allRoomsArea"],
        "ceiling_height": number(building["ceilingHeight"]),
        "renovation": F.coalesce(_filled(o["repairType"]), o["decoration"]),
        "bathrooms": counts_text([(o["separateWcsCount"], "разд."), (o["combinedWcsCount"], "совм.")]),
        "balcony": counts_text([(o["balconiesCount"], "балк."), (o["loggiasCount"], "лодж.")]),
        "parking": building["parking"]["type"],
        **{f"{k}_lifts": F.coalesce(_positive(building[f"{k}LiftsCount"]), o[f"{k}LiftsCount"], building[f"{k}LiftsCount"]) for k in ("passenger", "cargo")},
        "is_new_building": _true(new["id"] != 0) | _true(new["isFromDeveloper"]) | _true(new["isFromBuilder"]) | _true(geo["jk"]["name"] != ""),
        "nb_house_id": new["house"]["id"],
        "developer": _filled(new["name"]),
        "residential_complex": _filled(geo["jk"]["name"]),
        "completion_date": completion_text(deadline["quarter"], deadline["year"], finish["quarter"], finish["year"], new["newbuildingFeatures"]["deadlineInfo"]),
        "phone_protected": F.coalesce(F.size(o["phones"]), F.lit(0)) == 0,
        "photos_count": F.nullif(F.coalesce(F.size(o["photos"]), F.lit(0)), F.lit(0)),
        "views_total": total,
        "views_today": today,
        "price_history": F.to_json(price_history(changes)),
    }


ADDRESS_COLUMN = "folded_address_"


def _with_address(docs: DataFrame, offer: Column) -> DataFrame:
    """``docs`` with the folded address as one struct: seven columns read it, and it is folded once."""
    return docs.withColumn(ADDRESS_COLUMN, folded_address(offer["geo"]["address"]))


def _mapped(docs: DataFrame, source: str, columns: dict[str, Column]) -> DataFrame:
    kept = [k for k in docs.columns if k not in (source, ADDRESS_COLUMN) and k not in columns]  # a mapped column replaces one of its name
    return docs.select(*kept, *[x.alias(k) for k, x in columns.items()]).filter("price is not null")


def map_offers(docs: DataFrame, document: str = "document") -> DataFrame:
    """Flat columns beside those of ``docs`` from a struct column of the schema DOCUMENT; documents without price go."""
    d = F.col(document)
    return _mapped(_with_address(docs, d["offer"]), document, offer_columns(d["offer"], d["agent"], d["stats"], d["priceChanges"], F.col(ADDRESS_COLUMN)))


def map_api_offers(docs: DataFrame, offer: str = "offer") -> DataFrame:
    """The same from a struct column of the schema API_OFFER. Whether the house comes down may stand with the building,
    and without a word on it the seller is the owner if the account is a homeowner's."""
    o = F.col(offer)
    columns = offer_columns(o, o["user"], o["statistic"], o["priceChanges"], F.col(ADDRESS_COLUMN))
    columns["demolished_in_renovation"] = F.coalesce(columns["demolished_in_renovation"], o["building"]["demolishedInMoscowProgramm"])
    columns["seller_is_owner"] = F.coalesce(columns["seller_is_owner"], o["user"]["accountType"] == "homeowner", F.lit(False))
    return _mapped(_with_address(docs, o), offer, columns)


def sanitize(df: DataFrame, year: int) -> DataFrame:
    """Values outside their ranges become null, places need both coordinates, parts can't exceed the whole, and the price
    by area is worked out anew. Rules for absent columns don't apply."""
    has = lambda *names: {*names} <= {*df.columns}
    ranges = RANGES | dict.fromkeys(("year_built", "year_release"), (FIRST_YEAR, year + YEARS_AHEAD))
    out = df.withColumns({k: F.when(F.col(k).between(*r), F.col(k)) for k, r in ranges.items() if k in df.columns})
    if has("lat", "lon"):
        both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
        out = out.withColumns({k: F.when(both, F.col(k)) for k in ("lat", "lon")})
    if has("total_area"):
        out = out.withColumns(
            {k: F.when(~F.coalesce(F.col(k) > F.col("total_area"), F.lit(False)), F.col(k)) for k in ("living_area", "kitchen_area") if k in df.columns}
        )
    if has("floor", "total_floors"):
        out = out.withColumn(
            "total_floors",
            F.when(~F.coalesce((F.col("floor") > F.col("total_floors")) & (F.col("floor") != 0), F.lit(False)), F.col("total_floors")),
        )
    if has("price", "total_area"):
        out = out.withColumn("price_per_m2", (_positive(F.col("price")) / _positive(F.col("total_area"))).cast("bigint"))
    return out


def explode_offers(responses: DataFrame, text: str = "response") -> DataFrame:
    """One row for each offer of a search response, with the response's total."""
    own = responses.withColumn("r_", F.from_json(text, f"offerCount long, offersSerialized array<{OFFER}>"))
    return own.select(*[x for x in responses.columns if x != text], F.col("r_.offerCount").alias("total"), F.explode("r_.offersSerialized").alias("offer"))
