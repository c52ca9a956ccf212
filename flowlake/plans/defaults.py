"""The reference deployment's configuration, as data.

Source names are the logical ``schema.table`` names a ``Catalog`` maps to
paths; every constant here is a fixed value the results depend on.
"""

from __future__ import annotations

from flowlake.plans.daily_flows import FlowSpec
from flowlake.plans.transfers import TransferSource

ETH = "ethereum"

# Yield-bearing stablecoin flows (eleven branches, all unioned).
YIELD_STABLE_FLOWS = [
    FlowSpec("aave_v2", "lending", ("aave_v2_multichain.atoken_evt_mint",),
             burn_sources=("aave_v2_multichain.atoken_evt_burn",),
             protocol="aave-v2", join="chain_address"),
    FlowSpec("aave_v3", "lending_interest", ("aave_v3_multichain.atoken_evt_mint",),
             burn_sources=("aave_v3_multichain.atoken_evt_burn",),
             protocol="aave-v3", join="chain_address"),
    FlowSpec("susds", "zero_address", ("sky_ethereum.susds_evt_transfer",), chain=ETH, scale=1e18),
    FlowSpec("sdai", "paired", ("maker_ethereum.SavingsDai_evt_Deposit",),
             burn_sources=("maker_ethereum.SavingsDai_evt_Withdraw",),
             chain=ETH, scale=1e18, value_col="shares"),
    FlowSpec("usde", "zero_address", ("ethena_labs_ethereum.stakedusdev2_evt_transfer",),
             chain=ETH, scale=1e18),
    FlowSpec("sdeusd", "zero_address", ("elixir_ethereum.stdeusd_evt_transfer",),
             chain=ETH, scale=1e18),
    FlowSpec("srusd", "zero_address", ("reservoir_protocol_ethereum.savingcoin_evt_transfer",),
             chain=ETH, scale=1e18),
    FlowSpec("wsrusd", "zero_address", ("reservoir_protocol_ethereum.savingcoinv2_evt_transfer",),
             chain=ETH, scale=1e18),
    FlowSpec("syrup", "zero_address", ("maplefinance_v2_ethereum.pool_v2_evt_transfer",),
             protocol="maple", join="address", chain=ETH, scale=1e6,
             value_col="amount_", from_col="owner_", to_col="recipient_"),
    FlowSpec("compound_v2", "paired",
             ("compound_v2_ethereum.cerc20_evt_mint", "compound_v2_ethereum.cerc20delegator_evt_mint"),
             burn_sources=("compound_v2_ethereum.cerc20_evt_redeem",
                           "compound_v2_ethereum.cerc20delegator_evt_redeem"),
             protocol="compound-v2", join="address", chain=ETH, scale=1e8,
             value_col="mintTokens", burn_value_col="redeemTokens",
             date_from_time="evt_block_time"),
    FlowSpec("usd0pp", "zero_address", ("usual_ethereum.usd0pp_evt_transfer",),
             protocol="usual", join="address", chain=ETH, scale=1e18),
]


def _rwa(name: str, sources: tuple[str, ...], chain: str | None, enabled: bool = True,
         value_col: str = "value") -> FlowSpec:
    join = "chain_address" if chain is None else "address_fixed_chain"
    return FlowSpec(name, "zero_address", sources, join=join, chain=chain, since_start=True,
                    value_col=value_col, enabled=enabled)


# RWA flows. Franklin, Centrifuge and WisdomTree are computed by
# the source model but left out of its union (they report zero); they are
# listed disabled so the reference result is the default. Dinari reads an
# Arbitrum table but binds the Ethereum seed row, so it is always empty.
RWA_FLOWS = [
    _rwa("backed", ("bibta_gnosis.backedtokenimplementation_evt_transfer",), "gnosis"),
    _rwa("ondo", ("ondofinance_ethereum.ondofinance_evt_transfer",
                  "ondofinance_ethereum.usdy_evt_transfer",
                  "ondofinance_ethereum.usdyc_evt_transfer"), ETH),
    _rwa("blackrock", ("blackrock_buidl_ethereum.dstoken_evt_transfer",), ETH),
    _rwa("blackrock_multichain", ("buidl_token_multichain.buidl_token_evt_transfer",), None),
    _rwa("franklin", ("franklin_templeton_multichain.moneymarketfund_v5_evt_transfer",), None,
         enabled=False),
    _rwa("superstate", ("superstate_ethereum.ustb_evt_transfer",
                        "superstate_ethereum.superstatetokenv5_1_evt_transfer"), ETH),
    _rwa("centrifuge", ("jtrsy_multichain.tranche_evt_transfer",), None, enabled=False),
    _rwa("hashnote", ("hashnote_multichain.shortdurationyieldcoin_evt_transfer",), None,
         value_col="amount"),
    _rwa("wisdomtree", ("wtgxx_ethereum.erc20revocablecompliancestandard_evt_transfer",), ETH,
         enabled=False),
    _rwa("dinari", ("dinari_arbitrum.usfrd_evt_transfer",), ETH, value_col="amount"),
    _rwa("openeden", ("tbill_ethereum.openedenvaultv2_evt_transfer",), ETH),
    _rwa("spiko", ("spiko_multichain.token_evt_transfer",), None),
]

# SPL RWA flow (one physical table, action-labelled).
SPL_FLOW = FlowSpec("spl", "action", ("tokens_solana.transfers",), join="address",
                    chain="solana", value_col="amount", date_col="block_date",
                    address_col="token_mint_address", since_start=True)

# Reserve / savings-rate index sources.
AAVE_V2_INDEX = "aave_v2_multichain.lendingpool_evt_reservedataupdated"
AAVE_V3_INDEX = "aave_v3_multichain.pool_evt_ReserveDataUpdated"
AAVE_V3_INDEX_CHAINS = ["avalanche_c", "bnb", "ethereum", "polygon"]
AAVE_V3_L2_INDEX = "aave_v3_multichain.l2pool_evt_reservedataupdated"
AAVE_V3_L2_INDEX_CHAINS = ["arbitrum", "base", "ink"]
AAVE_V3_PLASMA_INDEX = "aave_v3_plasma.poolinstance_evt_reservedataupdated"
SKY_DRIP = "sky_ethereum.susds_evt_drip"
SKY_UNDERLYING = "0xdc035d45d973e3ec169d2276ddab16f1e407384f"
MAKER_DRIP_CALL = "maker_ethereum.pot_call_drip"
MAKER_UNDERLYING = "0x6b175474e89094c44da98b954eedeac495271d0f"
COMPOUND_V3_MARKETS = "curated.compound_v3_markets"
MORPHO_VAULTS = "curated.morpho_vaults"
TOKEN_PRICES = "curated.token_price"

# (curated.* are names of this package; a catalog maps them to the deployment's tables)
# Prices. Tokens priced at 1 USD by name, and one substitute
# token priced with another token's price.
FIXED_PRICE_NAMES = ["BUIDL", "BUIDL-I", "BENJI", "WTGXX"]
PRICE_ALIASES = {"0xe86845788d6e3e5c2393ade1a051ae617d974c09":
                 "0x96f6ef951840721adbf46ac996b59e0235cb985c"}

# USDT transfer sources, contract and decimals per chain.
TETHER_SOURCES = {
    "tether_arbitrum.ArbitrumExtension_evt_Transfer":
        TransferSource({"0xfd086bc7cd5c481dcc9c85ebe478a1c0b69fcbb9": ("arbitrum", 6)}),
    "bep20usdt_bnb.bep20usdt_evt_transfer":
        TransferSource({"0x55d398326f99059ff775485246999027b3197955": ("bnb", 18)}),
    "tether_ethereum.tether_usd_evt_transfer":
        TransferSource({"0xdac17f958d2ee523a2206206994597c13d831ec7": ("ethereum", 6)}),
    "tether_polygon.uchilderc20_evt_transfer":
        TransferSource({"0xc2132d05d31c914a87c6611c10748aeb04b58e8f": ("polygon", 6)}),
    "tether_tron.tether_usd_evt_transfer":
        TransferSource({"0xa614f803b6fd780986a42c78ec9c7f77e6ded13c": ("tron", 6)}),
    "tokens_solana.transfers":
        TransferSource({"Es9vMFrzaCERmJfrF4H2FYD4KCoNkY11McCe8BenwNYB": ("solana", 6)},
                       time_col="block_time", value_col="amount", from_col="from_owner",
                       to_col="to_owner", tx_hash_col="tx_id", index_col="tx_index",
                       contract_col="token_mint_address"),
}
# Source name aliases (logical name → physical identifier).
SOURCE_ALIASES = {"tokens_solana.tether_solana_transfers": "tokens_solana.transfers"}
